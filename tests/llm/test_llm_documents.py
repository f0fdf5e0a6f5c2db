"""Operators on documents against brute force, with the rows that are easily got wrong."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
import urllib.parse
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers
from xxhash import xxh64_intdigest

from tidemark.llm import byte_bpe, fingerprints, line_dedup, packing, quality, secret_scan, simhash, token_count
from tidemark.llm.components import components
from tidemark.llm.text import map_slices

CLASHES = "fp text_ h1 h2 line first near dropped doc_key dropped_key curve ids part role kept good n_words root".split()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ties and clashing extra columns."""
    long = " ".join(random.Random(3).choices(["alpha", "beta", "gamma", "delta"], k=40_000))
    line = "a line of more than sixteen characters"
    rows = [
        (1, None, "a"),
        (2, "", "b"),
        (3, long, "c"),
        (4, f"{line}\nsecond line of the document", "d"),
        (5, f"{line}\nthird line, another document", "d"),
        (5, f"{line}\nthird line, another document", "d"),
        (None, f"{line}!\nthe fourth line stands alone here", None),
        (6, " \t\n \v\f\r", "e"),
        (7, "one two", "e"),
        (8, "One\ttwo", "e"),
        (9, "\x1c sep\x1darated Σίσυφος İstanbul é 🙂🙂 <|endoftext|>  two  spaces \n\n end ", "f"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({name: F.lit(f"clash {name}") for name in CLASHES}).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=["docs", "odd", "empty"])
def table(request):
    return request.getfixturevalue(request.param)


def likeness_components(texts, percent=80):
    """The smallest id that each document reaches over pairs of that Jaccard likeness, by all pairs."""
    sets = {d: shingles(t) for d, t in sorted(texts.items())}
    roots = {d: d for d in sets}

    def root(d):
        while roots[d] != d:
            d = roots[d]
        return d

    ids = list(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    low, high = sorted((root(a), root(b)))
                    roots[high] = low
    return {d: root(d) for d in ids}


# 1: fingerprints


def test_fingerprints_equal_brute_force(table):
    order = sorted(texts_of(table), key=lambda r: (-(r[0] if r[0] is not None else -1), ))
    got = rows(fingerprints.with_next(table))
    by_id = defaultdict(list)
    for r in got:
        by_id[r[0]].append(r)
    assert len(got) == len(order)
    for k, (doc_id, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        changed = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        kept, kept_changed = fingerprints.sketch(text), fingerprints.sketch(changed)
        want = (
            doc_id,
            len(text),
            hashlib.sha256(changed.encode()).hexdigest(),
            fingerprints.to_bytes(kept).hex(),
            fingerprints.to_bytes(kept_changed).hex(),
            fingerprints.containment(kept, kept_changed),
            fingerprints.containment(kept, fingerprints.sketch(following)),
        )
        assert want in by_id[doc_id]


def shingles(text):
    w = text.encode().lower().split()
    return {b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_sketches_merge_and_estimate_containment():
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(5_000)]
    errors = []
    for _ in range(60):
        a = " ".join(rng.choices(vocabulary, k=rng.choice([3, 40, 400, 4_000])))
        b = a[: len(a) // 2] + " " + " ".join(rng.choices(vocabulary, k=300))
        sa, sb = fingerprints.sketch(a), fingerprints.sketch(b)
        both = np.array(sorted({xxh64_intdigest(s) for s in shingles(a) | shingles(b)}), np.uint64)
        assert fingerprints.merge(sa, sb).tolist() == fingerprints.normalise(both).tolist()
        true = len(shingles(a) & shingles(b)) / min(len(shingles(a)), len(shingles(b)))
        errors.append(abs(fingerprints.containment(sa, sb) - true))
        assert fingerprints.containment(sa, sa) == 1.0
    assert np.mean(errors) < 0.06
    nothing = fingerprints.sketch("")
    assert fingerprints.containment(nothing, nothing) == 1.0
    assert fingerprints.containment(nothing, fingerprints.sketch("a")) == 0.0
    assert fingerprints.from_string(fingerprints.to_bytes(sa).hex()).tolist() == sa.tolist()


# 2: secrets

SECRET = 'token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2"'


def open_spans(text):
    found = []
    for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 12:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_open_secrets_equal_the_plain_rules(table):
    got = rows(secret_scan.find_secrets(table).drop("spans", "n_deeper"))
    want = []
    for doc_id, text in texts_of(table):
        spans = open_spans(text)
        labels = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        counts = Counter(k for _, k, _ in spans)
        want.append((doc_id, counts[0], counts[1], counts[2], hashlib.sha256(labels.encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def wrap_url(s):
    return urllib.parse.quote(s, safe="")


def wrap_base64(s):
    return base64.b64encode(s.encode()).decode()


def wrap_gzip(s):
    return base64.b64encode(gzip.compress(s.encode(), mtime=0)).decode()


def wrap_escapes(s):
    return "".join(f"\\u{ord(c):04x}" for c in s)


@pytest.mark.parametrize("outer", [wrap_url, wrap_base64, wrap_gzip, wrap_escapes])
@pytest.mark.parametrize("inner", [None, wrap_url, wrap_base64, wrap_gzip, wrap_escapes])
def test_wrapped_secrets_are_found_in_place(outer, inner):
    body = inner(SECRET) if inner else SECRET
    wrapped = outer(body)
    text = f"prose é before {wrapped} and after"
    base, deeper = secret_scan.find(text)
    assert [tuple(f[:3]) for f in base] == open_spans(text)
    assigned = [f for f in deeper if f.rank == 0] or [f for f in base if f.rank == 0]
    start = text.index(wrapped)
    assert assigned and all(start <= f.start < f.end <= start + len(wrapped) for f in assigned)
    assert secret_scan.find(secret_scan.redact(text)) == ([], [])


@pytest.mark.parametrize("before, after", [("note%3A%20", ""), ("q=%22", "%22"), (r"x\u003d", ""), (r"\u0022", r"\u0022")])
def test_base64_behind_an_escape(before, after):
    # The hex digits of the escape belong to the alphabet of base64, and shift its groups.
    wrapped = wrap_base64(SECRET).rstrip("=")
    text = f"a {before}{wrapped}{after} b"
    deeper = secret_scan.find(text)[1]
    start = text.index(wrapped)
    assert any(f.rank == 0 and start <= f.start < f.end <= start + len(wrapped) for f in deeper)
    assert wrapped not in secret_scan.redact(text)


def wrap_lines(data):
    return base64.encodebytes(data).decode().rstrip("\n")


LONG = f"{'x ' * 29}{SECRET}{' y' * 40}"
NOISE = random.Random(5).randbytes(200).hex().upper()


@pytest.mark.parametrize(
    "before, wrapped, after",
    [
        ("https://h.example/cb/", wrap_base64(SECRET).rstrip("="), "/next"),
        ("id_", wrap_base64(SECRET), ""),
        ("key-", wrap_gzip(SECRET), ""),
        ("abc", wrap_base64(SECRET).rstrip("=")[:-1], ""),
        ("", wrap_lines(LONG.encode()), ""),
        ("mail:\n", wrap_lines(LONG.encode()).replace("\n", "\r\n  "), "\nend"),
        ("", wrap_lines(gzip.compress((NOISE + LONG).encode(), mtime=0)), ""),
        ("", wrap_lines(zlib.compress((NOISE + LONG).encode())), ""),
        ("", urllib.parse.quote(gzip.compress(SECRET.encode(), mtime=0)), ""),
        ("", "".join(f"\\x{b:02x}" for b in zlib.compress(SECRET.encode())), " Ω"),
        ("", r"\ud83d" + wrap_escapes(SECRET), ""),
        ("", "%FF" + "".join(f"%{b:02x}" for b in SECRET.encode()), ""),
        *(("", wrap_base64(f"é{c} {SECRET}"), "") for c in "\u00a0\u3000\u200b\u200d\ufeff\f\0"),
    ],
)
def test_base64_at_any_place_and_any_text_in_it(before, wrapped, after):
    text = f"a {before}{wrapped}{after} b"
    start = text.index(wrapped)
    found = [f for f in secret_scan.find(text)[1] if f.rank == 0]
    assert any(start <= f.start < f.end <= start + len(wrapped) + 3 for f in found)
    assert [f for f in secret_scan.find(secret_scan.redact(text))[1] if f.rank == 0] == []


def test_exact_places_and_leftmost_rule():
    text = "x pass%77ord=abcdefghijkl y"
    assert [f.label() for f in secret_scan.find(text)[1]] == ["assign:2:25"]
    assert secret_scan.redact(text) == "x pass%77ord=[SECRET] y"
    # A failing match uses up what it covers.
    assert secret_scan.find("token=password:abcdefghijklmnop") == ([], [])
    assert secret_scan.find("") == ([], [])


def test_a_cycle_ends():
    data = b"\x1f\x8b"
    real = secret_scan._decompressed
    secret_scan._decompressed = lambda d: data if d == data else real(d)
    try:
        assert secret_scan._unpacked(data) == (data, True)
    finally:
        secret_scan._decompressed = real


def test_redaction_keeps_rows_and_columns(odd):
    got = secret_scan.redact_documents(odd)
    assert got.columns == odd.columns and got.count() == odd.count()
    assert rows(got.select("doc_id", "text", "n_chars")) == rows(odd.select("doc_id", "text", "n_chars"))


# 3: lines


def edit_distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


def brute_lines(df):
    found = {(r[0] if r[0] is not None else line_dedup._LAST_ID, r[1]) for r in df.select("doc_id", "text").collect() if r[1] is not None}
    lines = []
    for doc_id, text in found:
        lines += [(doc_id, k, line_dedup.normalised(line), text) for k, line in enumerate(text.split("\n"))]
    lines = sorted(x for x in lines if x[2])
    kept, gone, seen = defaultdict(list), defaultdict(set), set()
    for doc_id, k, line, text in lines:
        near = line in seen
        for kind, parts in (("char", line), ("word", line.split(" "))):
            for n in (-1, 0, 1):
                met = kept[kind, len(parts) + n, parts[0]] + kept[kind, len(parts) + n, parts[-1], "end"]
                near = near or any(kind in {own_unit(line), own_unit(x)} and brute_near(line, x) for x in met)
            if line not in seen:
                kept[kind, len(parts), parts[0]].append(line)
                kept[kind, len(parts), parts[-1], "end"].append(line)
        seen.add(line)
        if near:
            gone[doc_id, text].add(k)
    return gone


def own_unit(line):
    return "word" if len(line) > 64 and line.count(" ") >= 7 else "char"


def brute_near(a, b):
    if min(len(a), len(b)) < line_dedup.MIN_CHARS:
        return False
    as_words = "word" in (own_unit(a), own_unit(b)) and edit_distance(a.split(" "), b.split(" ")) <= 1
    return as_words or ("char" in (own_unit(a), own_unit(b)) and edit_distance(a, b) <= 1)


def test_dropped_lines_equal_brute_force(table):
    got = {}
    for r in line_dedup.duplicate_lines(table).collect():
        got[r["doc_id"], r["doc_key"]] = r["dropped"]
    want = brute_lines(table)
    keys = {(r[0] if r[0] is not None else line_dedup._LAST_ID, r[1]): r[2] for r in table.select("doc_id", "text", F.xxhash64("doc_id", "text")).collect()}
    assert got == {(doc_id, keys[doc_id, text]): sorted(ks) for (doc_id, text), ks in want.items()}
    report = line_dedup.line_report(table)
    assert report.count() == table.count()


@settings(max_examples=300, deadline=None)
@given(
    st.one_of(
        st.text("abc ", min_size=14, max_size=67),
        st.lists(st.sampled_from(["aaaaaa", "bbbbbbb", "cccccc", "d", "eeeeeeeeeeee"]), min_size=6, max_size=40).map(" ".join),
    ),
    st.integers(0, 300),
    st.sampled_from(["a", "b", "", "cc", "x ", " y", " yyyyyyyyyyyyyyyy "]),
)
def test_near_lines_share_keys(line, at, put):
    a = line_dedup.normalised(line)
    b = line_dedup.normalised(a[:at] + put + a[at + 1 :])
    near = brute_near(a, b)
    assert line_dedup.within_one(a, b) == near == line_dedup.within_one(b, a)
    if not near or a == b:
        return
    met = set()
    for x in line_dedup.forms(a):
        for y in line_dedup.forms(b):
            if x.kind != y.kind or not (x.home or y.home):
                continue
            sides = {k & 1 for k in set(line_dedup.half_keys(*x[:2])) & set(line_dedup.half_keys(*y[:2]))}
            mine, theirs = (dict(line_dedup.variant_keys(*form[:2], sum(1 << k for k in sides))) for form in (x, y))
            met |= {(mine[k], theirs[k]) for k in mine.keys() & theirs.keys()} if sides else set()
    assert met & {(2, 2), (0, 1), (1, 0)}


def test_variant_keys_equal_those_of_the_variants():
    words = [f"w{k % 7}" for k in range(30)]
    for parts in (words, " ".join(words)):
        kind = "char" if isinstance(parts, str) else "word"
        whole = {}
        for k in range(len(parts)):
            whole[next(line_dedup.variant_keys(kind, parts[:k] + parts[k + 1 :]))[0]] = k
        shorter = {key for key, role in line_dedup.variant_keys(kind, parts) if role == line_dedup.SHORTER}
        assert shorter == set(whole)


def test_short_lines_and_lines_at_the_bounds(spark):
    words = "one word after the other makes a line of ten"
    exactly = "x" * 20 + " " + "y" * 20 + " a b c d e f g h i jj"
    long_seven = " ".join(f"word{k}longer{k}" for k in range(7))
    huge = "z" * 300_000
    cases = [
        ("Subscribe now", "Subscribe now", True),
        ("Subscribe now", "Subscribe not", False),
        ("|", "|", True),
        (exactly + "k" * (64 - len(exactly)), exactly + "k" * (65 - len(exactly)), True),
        (long_seven, long_seven + " eighth", True),
        (long_seven + " eighth", long_seven, True),
        (words, words + " " + "q" * 40, True),
        (huge, huge[:150_000] + "y" + huge[150_000:], True),
        (" \t", " \t", False),
    ]
    for k, (first, second, goes) in enumerate(cases):
        rows_ = [(1, first), (2, second)]
        got = line_dedup.line_report(spark.createDataFrame(rows_, "doc_id long, text string"))
        assert {r["doc_id"]: r["n_dropped"] for r in got.collect()} == {1: 0, 2: int(goes)}, k


def test_guests_are_not_compared_with_guests(spark):
    base = "one two three four five six seven eight"  # under 65 characters: a guest among lines of words
    other = base.replace("eight", "zzzzz")  # five characters, but one word away
    long = base.replace("eight", "e" * 40)  # at home among lines of words, and near both
    assert not line_dedup.within_one(base, other) and line_dedup.within_one(long, other)
    table = spark.createDataFrame([(1, base), (2, other), (3, long), (4, base.replace("eight", "four"))], "doc_id long, text string")
    assert {r["doc_id"]: r["n_dropped"] for r in line_dedup.line_report(table).collect()} == {1: 0, 2: 0, 3: 1, 4: 1}


def test_documents_without_their_lines(odd):
    got = line_dedup.without_duplicate_lines(odd)
    assert got.columns == odd.columns and got.dtypes == odd.dtypes
    left = {(r["doc_id"], r["text"], r["n_chars"]) for r in got.collect()}
    assert (5, "third line, another document", 28) in left
    assert (None, "the fourth line stands alone here", 33) in left
    assert (1, None, None) in left and (2, "", 0) in left


# 4: byte-level BPE


@pytest.fixture(scope="module")
def reference_bpe():
    path = public_tokenizers.path(byte_bpe.RANKS)
    ranks = byte_bpe.read_ranks(path)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_round_trip_equals_the_rank_library(table, reference_bpe):
    want = []
    for doc_id, text in texts_of(table):
        ids = np.array(reference_bpe.encode_ordinary(text), "<u4")
        want.append((doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert rows(byte_bpe.round_trip(table)) == sorted(want, key=repr)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("erasn.0l e\n\t  ", max_size=60)))
def test_ids_offsets_and_bytes(text):
    tokenizer = byte_bpe.bpe(public_tokenizers.path(byte_bpe.RANKS))
    library = tiktoken.Encoding("own2", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokenizer.ranks, special_tokens={}) if not hasattr(tokenizer, "peer") else tokenizer.peer
    tokenizer.peer = library
    ids = tokenizer.encode(text)
    assert ids.tolist() == library.encode_ordinary(text)
    assert tokenizer.decode(ids.tolist()) == text.encode()
    starts, ends = tokenizer.offsets(text, ids)
    for token, a, b in zip(ids.tolist(), starts, ends, strict=True):
        assert tokenizer.tokens[token] in text[a:b].encode()


def test_decoding_handles_split_characters(odd):
    encoded = byte_bpe.encode(odd)
    decoded = byte_bpe.decode(encoded)
    assert sorted(r["text"] for r in decoded.collect()) == sorted(t for _, t in texts_of(odd))
    part = byte_bpe.decode(encoded.where("doc_id = 9").select("doc_id", F.expr("slice(ids, 1, size(ids) - 1)").alias("ids")))
    assert part.first()["data"] == b"".join([part.first()["data"]])


# 6: token counts


def test_counts_equal_the_unigram_library(table):
    vocabulary = token_count.read_vocabulary(public_tokenizers.path(token_count.MODEL))
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement=token_count.MARK, prepend_scheme="always", split=True)
    want = [(d, len(t), len(library.encode(t, add_special_tokens=False).ids)) for d, t in texts_of(table)]
    assert rows(token_count.token_counts(table)) == sorted(want, key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=3), st.integers(-4, -1)), min_size=1, max_size=9), st.text("abcd", min_size=1, max_size=12))
def test_ties_follow_the_library(pieces, word):
    scores = {"<unk>": 0.0, **{f"<0x{b:02X}>": -99.0 for b in range(256)}, **{p: float(s) for p, s in pieces}}
    library = Tokenizer(models.Unigram(list(scores.items()), unk_id=0, byte_fallback=True))
    assert token_count.UnigramCounter(list(scores.items())).count_chunk(word) == len(library.encode(word).ids)


# 7: near duplicates


def plain_simhash(text):
    w = text.encode().lower().split()
    grams = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(found):
    parent = {f: f for f in found.values()} if isinstance(found, dict) else {f: f for _, f in found}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    nodes = list(parent)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    return {f: root(f) for f in nodes}


def test_components_equal_all_pairs(table):
    found = [(d, plain_simhash(t)) for d, t in texts_of(table)]
    roots = brute_components(found)
    least = defaultdict(list)
    for d, f in found:
        least[roots[f]] += [d] if d is not None else []
    want = sorted(((d, f - (1 << 64) if f >> 63 else f, min(least[roots[f]], default=None)) for d, f in found), key=repr)
    assert rows(simhash.near_duplicates(table)) == want


def test_crowded_keys_lose_no_link(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 150:
        f = rng.choice(list(fps))
        for _ in range(rng.randint(1, 4)):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    distinct = spark.createDataFrame(signed, "fp long")
    want = brute_components(list(enumerate(fps)))
    sizes = sorted(Counter(want.values()).values())
    for crowd in (1, 4, 1000):
        rooted = components(simhash.links(distinct, 3, crowd), "a", "b").collect()
        got = Counter(r["root"] for r in rooted)
        assert sorted(got.values()) == [n for n in sizes if n > 1]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(1000, k) for k in range(1001, 1100)] + [(7, 7), (None, 3), (2, 1)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {(r["node"], r["root"]) for r in got} == {(k, 1) for k in range(1, 61)} | {(k, 1000) for k in range(1000, 1100)}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_one_of_each_stays(odd):
    left = simhash.keep_one_of_each(odd)
    assert left.columns == odd.columns
    # 1, 2 and 6 have no word; 7 and 8 are equal but for case and white space; 5 stands twice.
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == [1, 3, 4, 5, 5, 7, 9]


def altered(rng, tokens, n):
    """The words with ``n`` of them replaced."""
    out = list(tokens)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def test_near_copies_are_found_by_slices(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(20_000)]
    texts, pairs = {}, 0
    for k in range(400):
        n = rng.choice([12, 30, 60, 110, 200, 420, 1_500])
        tokens = rng.choices(vocabulary, k=n)
        texts[2 * k] = " ".join(tokens)
        # Each replaced word changes five shingles: a likeness from just under 0.8 up.
        texts[2 * k + 1] = altered(rng, tokens, rng.randint(0, max(1, round(n * 0.023))))
        x, y = shingles(texts[2 * k]), shingles(texts[2 * k + 1])
        pairs += 100 * len(x & y) >= 80 * len(x | y)
    rows = [(d, t) for d, t in texts.items()]
    got = dict(simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want = likeness_components(texts)
    assert pairs > 250
    wrong = [d for d in texts if got[d] != want[d]]
    assert all(got[d] == d for d in wrong) and len(wrong) <= 0.03 * pairs


def test_a_crowd_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(5_000)}" for _ in range(120)]
    texts = {k: altered(rng, base, rng.randint(0, 2)) for k in range(700)} | {k: f"other text number {k} " * 9 for k in range(700, 760)}
    rows = [(d, t) for d, t in texts.items()]
    got = dict(simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want = likeness_components(texts)
    assert sum(got[d] != want[d] for d in texts) <= 7


def test_a_block_without_its_neighbours_is_compared_whole(spark, monkeypatch):
    """What neighbours do not find, all pairs of the blocks do."""
    none = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(simhash, "_neighbours", lambda keyed: none)
    rng = random.Random(6)
    base = [f"w{rng.randrange(5_000)}" for _ in range(120)]
    texts = {k: altered(rng, base, rng.randint(0, 4)) for k in range(150)} | {k: f"other text number {k} " * 9 for k in range(150, 170)}
    got = dict(simhash.similar_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect())
    want = likeness_components(texts)
    assert sum(got[d] != want[d] for d in texts) <= 2


def test_odd_rows_and_similar_documents(odd, empty):
    got = rows(simhash.similar_documents(odd))
    ids = [r[0] for r in got]
    assert sorted(ids, key=repr) == sorted([1, 2, 3, 4, 5, 5, None, 6, 7, 8, 9], key=repr)
    # 1, 2 and 6 have no words; two short texts differ in case and white space only.
    assert {(2, 1), (6, 1), (8, 7), (5, 5)} <= set(got)
    assert simhash.similar_documents(empty).count() == 0


def test_sets_of_like_sizes_share_a_cut():
    for size in [*range(1, 400), 1_000, 5_000]:
        assert all(set(simhash.cuts(size)) & set(simhash.cuts(other)) for other in range(size, size * 5 // 4 + 1))


# 8: packing


def test_every_id_is_packed_once(table):
    library = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    library.encode_special_tokens = True
    ids = defaultdict(list)
    for d, t in texts_of(table):
        ids[d].append(np.array(library.encode(t, add_special_tokens=False).ids + [1], "<u4"))
    pieces = packing.pack(table).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    import zlib

    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == set(ids)
    for d, found in by_doc.items():
        assert sum(p["length"] for p in found) == sum(map(len, ids[d]))
        for p in found:
            cuts = {zlib.crc32(i[p["start"] : p["start"] + p["length"]].tobytes()) for i in ids[d] if len(i) == p["doc_tokens"]}
            assert p["ids_crc32"] in cuts
        if len(ids[d]) == 1:
            assert sorted(p["start"] for p in found)[0] == 0
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0


def test_hilbert_curve_visits_neighbours():
    side = np.arange(8)
    grid = np.stack(np.meshgrid(side, side, side), -1).reshape(-1, 3)
    keys = packing.hilbert_key(grid, 3)
    assert sorted(keys) == list(range(512))
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_word_ids_equal_the_library(text):
    library = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY)) if not hasattr(packing, "_peer") else packing._peer
    packing._peer = library
    library.encode_special_tokens = True
    assert packing.word_bpe(public_tokenizers.path(packing.VOCABULARY)).encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_word_ids_of_many_texts_are_found_together(monkeypatch):
    """New words of letters are merged together, each distinct word is looked up once, ids equal the library's."""
    rng = random.Random(8)
    letters = "aabcdeeeghinorsttué中ß"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(6_000)]
    words += [w + rng.choice([".", ",!!", "$$$", "'s", "_", "1", "’", "'re."]) for w in words[:1_500]]
    spaces = [" ", "  ", "\n", "\t\r", "\u00a0", "\u2003", "\x85", "\x1c", "\u3000"]
    texts = ["".join(w + rng.choice(spaces) for w in rng.choices(words, k=200)) for _ in range(150)]
    texts += ["", " ", "\x1f", "Σ" + words[0] + "Σ", "e\u0301a", "x" * 70]
    path = public_tokenizers.path(packing.VOCABULARY)
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    asked = Counter()
    by_word = packing.WordBpe._word_ids
    monkeypatch.setattr(packing.WordBpe, "_word_ids", lambda self, w: asked.update([w]) or by_word(self, w))
    for limit in (250_000, 100):
        tokenizer = packing.WordBpe(path)
        tokenizer.words.limit = limit
        asked.clear()
        assert [i.tolist() for i in tokenizer.encode_all(texts[:-1])] == want[:-1]
        # The library merges none of the words of letters.
        assert not any(w.isalpha() for w in asked)
        assert [i.tolist() for i in tokenizer.encode_all(texts)] == want
        assert tokenizer.encode_all([]) == []


# 9: quality


def plain_signals(text):
    w = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_signals_equal_the_plain_rules(table):
    got = rows(quality.judge(table, None).drop("good"))
    want = []
    for d, t in texts_of(table):
        n = plain_signals(t)
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        want.append((d, *n, failed, not failed))
    assert got == sorted(want, key=repr)


def test_classifier_on_held_out_rows(spark):
    folder = SF_DIR.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    training, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    model = quality.train(docs, training)
    judged = quality.judge(docs.join(held, "doc_id", "left_semi"), model).join(held, "doc_id").where("not base_failed").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in judged)
    assert len(judged) > 100 and right >= 0.97 * len(judged)
    good = [r["good"] for r in judged]
    assert all(0 <= g <= 1 for g in good)


def test_training_needs_both_labels(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.train(docs, labels) is None
    assert quality.train(empty, labels) is None


def test_keep_good_keeps_columns(odd, docs):
    assert quality.keep_good(odd, None).columns == odd.columns
    kept = {r["doc_id"] for r in quality.keep_good(docs, None).collect()}
    assert kept == {r["doc_id"] for r in quality.judge(docs, None).where("kept").collect()}


def test_workers_forget_what_other_stages_made_them_remember(spark):
    """A worker that has tokenised or judged holds neither tokenizer nor words when other rows come."""
    rows = [(k, f"some words of document number{k}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)

    def remembered(columns):
        held = packing.word_bpe.cache_info().currsize + quality._word_hash.cache_info().currsize
        yield {"held": [held] * len(columns["text"])}

    for work in (packing.tokenised(df), quality.judge(df, quality.Model(np.zeros(2**quality.BITS + 1)))):
        before = work.collect()
        assert len(before) == len(rows)
        held = map_slices(df.select("text"), remembered, "held long").collect()
        assert {r["held"] for r in held} == {0}
