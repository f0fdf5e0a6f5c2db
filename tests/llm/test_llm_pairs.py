"""Alignment, fill-in-the-middle and the LSH forest against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_DIR
from oracle import connect, difference
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import crowds, fill_middle, minhash_forest, spill_align
from tidemark.llm.components import components
from tidemark.llm.queries import ORACLES, QUERIES

CLASHES = "node label tree path region a b n run radix pairs records piece place form content task section bits".split()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, marks, odd white space, clashing columns."""
    long = " ".join(random.Random(3).choices(["alpha", "beta", "gamma", "delta"], k=40_000))
    base = [f"w{k}" for k in range(60)]
    rows = [
        (1, None),
        (2, ""),
        (3, long),
        (4, " \t\n \v\f\r"),
        (5, "one"),
        (6, "One"),
        (7, "one two"),
        (8, "a text with <S> in it"),
        (9, "a piece▁mark"),
        (10, "\x1c sep\x1darated Σίσυφος İstanbul é 🙂🙂 <|endoftext|> </s> <0x41>  two  spaces \n\n end "),
        (11, "\n\nlines\n first\r\n　wide\xa0space and\x85more﻿​ x\x00y"),
        (12, "<" * 50 + "S"),
        (13, " ".join(base)),
        (14, " ".join([*base[:30], "changed", *base[31:]])),
        (15, " ".join(base).upper()),
        (15, " ".join(base)),
        (None, " ".join([*base[:-1], "end"])),
        (None, None),
        (None, None),
        (16, "x" * 30_000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({name: F.lit(f"clash {name}") for name in CLASHES}).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(params=["docs", "odd", "empty"])
def table(request):
    return request.getfixturevalue(request.param)


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# 11: alignment


def tokens():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(x): x for x in own} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in own)}

    def both(text):
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        data = (" " + text).encode()
        if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            return None
        return ids_a, np.cumsum([len(x) for x in bytes_a]).tolist(), ids_b, np.cumsum([len(x) for x in bytes_b]).tolist()

    return both


def aligned_by_hand(texts):
    both, found, held = tokens(), [], Counter()
    for doc_id, text in texts:
        got = both(text)
        if got is None:
            found.append((doc_id, None))
            continue
        ids_a, ends_a, ids_b, ends_b = got
        links, i, j = [], 0, 0
        while i < len(ids_a) and j < len(ids_b):
            links.append((ids_a[i], ids_b[j]))
            i, j = i + (ends_a[i] <= ends_b[j]), j + (ends_b[j] <= ends_a[i])
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, start = [], 0
        for end in cuts:
            own_a = [str(t) for t, e in zip(ids_a, ends_a) if start < e <= end] if len(ids_a) < 300 else None
            if own_a is None:
                break
            own_b = [str(t) for t, e in zip(ids_b, ends_b) if start < e <= end]
            groups.append(",".join(own_a) + "|" + ",".join(own_b))
            start = end
        digest = sha(";".join(groups)) if len(ids_a) < 300 else None
        found.append((doc_id, (len(ids_a), len(ids_b), len(cuts), links, digest)))
        held.update(set(links))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, got in found:
        if got is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n_groups, links, digest = got
            n_best = sum(held[x] == best[x[0]] for x in links)
            out.append((doc_id, n_a, n_b, n_groups, len(links), n_best, sum(held[x] for x in links), digest))
    return out


def test_alignment_equals_brute_force(table):
    found = rows(spill_align.align(table))
    want = sorted(aligned_by_hand(texts_of(table)), key=repr)
    assert [r[:-1] for r in found] == [r[:-1] for r in want]
    assert all(w[-1] in (None, f[-1]) for f, w in zip(found, want, strict=True))


def test_alignment_does_not_depend_on_runs_radix_or_fan_in(docs):
    whole = rows(spill_align.align(docs))
    assert rows(spill_align.align(docs.repartition(5), radix=3, run_chars=20_000, fan_in=2)) == whole


def test_pair_counts(docs):
    texts = texts_of(docs)[:60]
    some = docs.where(F.col("doc_id").isin([i for i, _ in texts]))
    runs = spill_align.write_runs(some, run_chars=5_000)
    _, final = spill_align.final_counts(runs, fan_in=4)
    both, held = tokens(), Counter()
    for _, text in texts_of(some):
        if got := both(text):
            ids_a, ends_a, ids_b, ends_b = got
            starts_a, starts_b = [0, *ends_a], [0, *ends_b]
            held.update({(a, b) for a, s, e in zip(ids_a, starts_a, ends_a) for b, s2, e2 in zip(ids_b, starts_b, ends_b) if s < e2 and s2 < e} if len(ids_a) < 400 else set())
    found = {(r["a_id"], r["b_id"]): r["n_docs"] for r in spill_align.pair_counts(final).collect()}
    assert all(found[pair] >= n for pair, n in held.items())


def test_merge_of_frames_equals_a_counter():
    rng = np.random.Generator(np.random.PCG64(1))
    frames, want = [], Counter()
    for size in (0, 1, 5, 70_000, 200_000, 3):
        keys, counts = np.unique(rng.integers(0, 150_000, size).astype(np.uint64), return_counts=True)
        want.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        out = spill_align._Pairs()
        out.add(keys, counts)
        frames.append(out.done())
    found = [(k, v) for keys, values in spill_align.merged(frames) for k, v in zip(keys.tolist(), values.tolist(), strict=True)]
    assert found == sorted(want.items())


def test_groups_spell_the_text(docs):
    words = spill_align.Words(*spill_align._paths(None, None))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in spill_align.token_groups(docs).collect():
        for side, table in ((0, words.bytes_a), (1, words.bytes_b)):
            ids = [int(i) for g in r["groups"].split(";") for i in g.split("|")[side].split(",")] if r["groups"] else []
            assert b"".join(table[i] for i in ids).decode() == (" " + texts[r["doc_id"]] if ids else "")


def test_plain_words_are_merged_without_the_library(monkeypatch):
    """Words of letters, with or without marks behind, have the ids that the library gives them."""
    rng = random.Random(11)
    words = ["".join(rng.choices("aabcdeeeghinorsttuÉ中ß", k=rng.randint(1, 12))) for _ in range(4_000)]
    words += [w + rng.choice([".", ",!!", "$$$", "'s", "_", "1", "’", "<|endoftext|>"]) for w in words[:1_500]]
    words = [" " + w for w in dict.fromkeys(words)] + ["\nline", " ", " \tx", " " + "y" * 90, " ''", " 's"]
    paths = spill_align._paths(None, None)
    found = spill_align.Words(*paths)
    library = Tokenizer.from_file(paths[0])
    library.encode_special_tokens = True
    want = {w: e.ids for w, e in zip(words, library.encode_batch(words, add_special_tokens=False), strict=True)}
    plain = found._plain(words)
    assert len(plain) > 4_000 and all(want[w] == ids for w, ids in plain.items())
    # As texts they have the groups that the library's ids alone lead to.
    texts = [w[1:] for w in words if w[0] == " "]
    got = [g for _, g in spill_align._aligned(found, texts)]
    alone = spill_align.Words(*paths)
    alone.merges = None
    assert got == [g for _, g in spill_align._aligned(alone, texts)]
    assert found.stats.tolist() == alone.stats.tolist()


# 12: fill-in-the-middle


def by_hand(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        return (doc_id, n, "spm", a, b - a, sha(f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"), sha(text))
    return (doc_id, n, "psm", a, b - a, sha(f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"), sha(text))


@pytest.mark.parametrize("chunk", [1, 7, 32_768])
def test_fill_middle_equals_brute_force(table, chunk, monkeypatch):
    texts = texts_of(table)
    if chunk < 10:
        texts = [(i, t) for i, t in texts if len(t) < 500]
        for doc_id, text in texts:
            form, prefix, middle = fill_middle.plan(doc_id, text)
            monkeypatch.setattr(fill_middle, "CHUNK", chunk)
            chunks = list(fill_middle.output_chunks(text, form, prefix, middle))
            assert sha("".join(chunks)) == by_hand(doc_id, text)[5]
            parser, parts = fill_middle.Parser(form), ["", "", ""]
            for c in "".join(chunks):
                for section, part in parser.feed(c):
                    parts[section] += part
            assert "".join(parts) + parser.held == text
        return
    placed = fill_middle.pieces(table)
    assert rows(fill_middle.digests(placed)) == sorted((by_hand(*t) for t in texts), key=repr)
    made = rows(fill_middle.outputs(placed))
    assert sorted(sha(r[-1]) for r in made) == sorted(by_hand(*t)[5] for t in texts)


def test_fill_middle_spreads_equal_rows(spark):
    same = spark.range(0, 5000, 1, 8).select(F.lit(4).cast("long").alias("doc_id"), F.lit("the same text").alias("text"))
    placed = fill_middle.pieces(same)
    assert placed.select("task").distinct().count() == 8
    found = fill_middle.digests(placed)
    assert found.count() == 5000 and found.distinct().count() == 1


def test_fill_middle_equals_its_twin(spark):
    assert difference(QUERIES["op12_fill_middle"](spark, SF_DIR), connect(SF_DIR), ORACLES["op12_fill_middle"]) is None


# 13: MinHash near-dedup


def components_by_hand(texts, size=2):
    sets = []
    for _, text in texts:
        w = [x for x in text.encode().lower().split()]
        sets.append({b" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                root[find(i)] = find(j)
        for s in own:
            holders[s].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(texts):
        r = find(i)
        least[r] = min((x for x in (least.get(r), doc_id) if x is not None), default=None)
    return sorted(((d, len(s), least[find(i)], d == least[find(i)]) for i, ((d, _), s) in enumerate(zip(texts, sets, strict=True))), key=repr)


def test_forest_equals_brute_force(table):
    assert rows(minhash_forest.near_duplicates(table)) == components_by_hand(texts_of(table))


def crowd(seed=5, n=400, words=200):
    """Near copies of one text with a border around the threshold, and strangers that share half of it."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    texts = []
    for k in range(n):
        own = list(base)
        for _ in range(rng.randrange(0, 30)):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        if k % 10 == 0:
            own[: words // 2] = [f"y{rng.randrange(10**6)}" for _ in range(words // 2)]
        texts.append((k, " ".join(own)))
    return texts


def test_forest_in_a_crowd(spark):
    """Regions too large for all pairs: recall of components in a crowd at the threshold."""
    texts = crowd()
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found, want = rows(minhash_forest.near_duplicates(df)), components_by_hand(texts)
    wrong = sum(a != b for a, b in zip(found, want, strict=True))
    assert wrong <= 0.01 * len(texts)


def test_forest_finds_nine_in_ten_pairs_at_the_threshold(spark):
    """Pairs just above a likeness of 0.8, alone: all are found; just below it: none."""
    rng, texts = random.Random(9), []
    for k in range(300):
        own = [f"p{k}w{j}" for j in range(401)]
        # A changed word changes two of 400 shingles: 22 changed words leave 356 of 444, or 0.8018.
        other = list(own)
        for j in rng.sample(range(1, 400, 2), 22 if k % 2 else 23):
            other[j] = f"q{k}w{j}"
        texts += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(other))]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in minhash_forest.near_duplicates(df).collect()}
    assert [found[2 * k + 1] == 2 * k for k in range(300)] == [bool(k % 2) for k in range(300)]


# Crowds: groups too large for all pairs


def near_crowd(seed, n, groups):
    """Sets around a few centres with a border at the threshold, some of them with edits in common."""
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(150)]
    variants = [base[: 150 - 12 * g] + [rng.getrandbits(64) for _ in range(12 * g)] for g in range(groups)]
    sets = []
    for _ in range(n):
        own = list(rng.choice(variants))
        for at in rng.sample(range(len(own)), rng.randrange(0, 30)):
            own[at] = rng.getrandbits(64)
        sets.append(own[: rng.randrange(len(own) - 8, len(own) + 1)])
    return [np.unique(np.array(s, np.uint64)) for s in sets]


@pytest.mark.parametrize("groups", [1, 4])
def test_crowds_lose_no_link(spark, groups):
    sets = near_crowd(3 + groups, 260, groups)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if crowds.alike(x, sets[j], 80):
                root[max(find(i), find(j))] = min(find(i), find(j))
    want = {k: find(k) for k in range(len(sets))}
    assert 5 < len(set(want.values())) < 200
    full = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(sets)], "node long, full binary")
    rows = spark.createDataFrame([(7, k, k, len(s)) for k, s in enumerate(sets)], "group long, node long, label long, n long")
    for few in (0, 50, 10**6):
        found = components(crowds.links_in_groups(rows, full, 80, limit=0, few=few), "a", "b").collect()
        got = {k: k for k in want} | {r["node"]: r["root"] for r in found}
        assert got == want


def test_crowds_are_compared_in_tiles_not_by_rows(spark, monkeypatch):
    """As all pairs, over many small tiles; no table has a row for each pair or difference."""
    sets, n_rows = near_crowd(11, 300, 4), {}
    root = {k: k for k in range(len(sets))}
    for i, x in enumerate(sets):
        for j in range(i):
            if root[i] != root[j] and crowds.alike(x, sets[j], 80):
                root = {k: min(root[i], root[j]) if r in (root[i], root[j]) else r for k, r in root.items()}
    whole = crowds.written

    def written(frame, label):
        made = whole(frame, label)
        n_rows[label] = n_rows.get(label, 0) + made.count()
        return made

    monkeypatch.setattr(crowds, "written", written)
    monkeypatch.setattr(crowds, "TILE_ROWS", 40, raising=False)
    full = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(sets)], "node long, full binary")
    rows = spark.createDataFrame([(7, k, k, len(s)) for k, s in enumerate(sets)], "group long, node long, label long, n long")
    found = components(crowds.links_in_groups(rows, full, 80, limit=0, few=0), "a", "b").collect()
    assert {k: k for k in root} | {r["node"]: r["root"] for r in found} == root
    assert sum(n_rows.values()) < 10 * len(sets), n_rows


@pytest.mark.parametrize("broadcast", ["-1", "1g"])
def test_texts_of_full_sets_are_shuffled_once(spark, broadcast, monkeypatch):
    """Whether Spark broadcasts or not, texts are shuffled by their digest alone, and sets are not."""
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words), " ".join(words), " ".join([*words, "more"]), "nothing else"]
    df = spark.createDataFrame([*enumerate(texts), (2, texts[2])], "doc_id long, text string")
    seen = {}

    def written(frame, label):
        seen[label] = frame
        return frame

    table = minhash_forest.nodes(df).cache()
    monkeypatch.setattr(minhash_forest, "written", written)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        trees = table.where("signature is not null").select("node")
        sets = minhash_forest._full_sets(df, table, trees, minhash_forest.SHINGLE)
        plan = sets._jdf.queryExecution().executedPlan().toString()
        found = {bytes(r["node"]): bytes(r["full"]) for r in sets.collect()}
        assert sets.count() == len(found) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = {minhash_forest.shingle_set(t).tobytes() for t in texts[:3]}
    assert set(found.values()) == want
    # Above the join with the nodes that are wanted there is no shuffle; below it one for the texts.
    above, below = plan.split("Join", 1)
    assert "Exchange" not in above
    assert "text_id" in below and "Exchange hashpartitioning(text_id" in below
