import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from loomspan.llm import bpe, codes, divergence

from . import helpers as H

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ours = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    return ours, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


def ids_of(ours, text):
    return np.frombuffer(ours.encode(text), "<u4").tolist()


def test_bpe_equals_the_library(both):
    ours, theirs = both
    draw = random.Random(3)
    letters = "abcdeABC   \n\t\r'sréñß漢字中文🙂👍🏽́‍\x85\x1c　123٣४①-=_*/#<|endoftext|>"
    for _ in range(4000):
        text = "".join(draw.choice(letters) if draw.random() < 0.7 else chr(draw.choice([draw.randrange(128), draw.randrange(0x3000), draw.randrange(0xE000, 0x1F000)])) for _ in range(draw.randrange(50)))
        ids = ids_of(ours, text)
        assert ids == theirs.encode_ordinary(text)
        assert ours.decode(np.array(ids, "<u4").tobytes()) == text.encode()
    for text in ("a" * 50_000, "".join(draw.choice("abcdefgh") for _ in range(60_000)), "漢字" * 9_000, " " * 20_001, "-" * 30_001, "", "<|endoftext|>"):
        assert ids_of(ours, text) == theirs.encode_ordinary(text)


def test_bpe_letters_newer_than_the_library_s(both):
    ours, theirs = both
    for text in ("a\U000107bbb", "x \U00011de0y", "꟒ 1\U00011de0"):
        assert ids_of(ours, text) == theirs.encode_ordinary(text)


def test_bpe_with_tokens_that_merges_do_not_reach(tmp_path):
    """'abc' can't be merged (neither 'ab' nor 'bc' is a token); ties and overlaps of one rank go to the left."""
    import base64

    tokens = [bytes([i]) for i in range(256)] + [b"abc", b"aa", b"aaa", b"xy", b"yx", b"xyx"]
    path = tmp_path / "own.tiktoken"
    path.write_text("\n".join(f"{base64.b64encode(t).decode()} {i}" for i, t in enumerate(tokens)) + "\n")
    ours = bpe.Codec(str(path), r"\S+|\s+")
    theirs = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ours.ranks, special_tokens={})
    draw = random.Random(4)
    for text in ("abc", "abcabc", "aaaaa", "xyxyx", *("".join(draw.choice("abcxy") for _ in range(draw.randrange(1, 30))) for _ in range(3000))):
        assert ids_of(ours, text) == theirs.encode_ordinary(text), text


def test_bpe_rows(spark, both):
    ours, theirs = both
    df = H.documents(spark, H.odd_rows()).withColumn("ids", F.lit("clash")).withColumn("row", F.lit("x"))
    made = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    assert sorted(made.columns) == sorted(df.columns)
    back = bpe.decode(made, RANKS, out="row").collect()
    assert len(back) == len(H.odd_rows())
    for r in back:
        assert r["ids"] == theirs.encode_ordinary(r["text"] or "") and bytes(r["row"]) == (r["text"] or "").encode()
    got = bpe.round_trip(df, RANKS, public_tokenizers.PATTERN).collect()
    want = Counter()
    for doc, text, *_ in H.odd_rows():
        ids = theirs.encode_ordinary(text or "")
        want[doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, got)) == want
    assert bpe.round_trip(H.documents(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert sorted((r["decoded"] is None, bytes(r["decoded"] or b"")) for r in bpe.decode(nulls, RANKS).collect()) == [(False, b""), (True, b"")]
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([([60_000],)], "ids array<int>"), RANKS).collect()


def test_bpe_query_over_whole_table(spark, medium, both):
    _, theirs = both
    df = spark.read.parquet(f"{medium}/documents.parquet")
    got = {r[0]: tuple(r[1:]) for r in bpe.round_trip(df, RANKS, public_tokenizers.PATTERN).collect()}
    for doc, text in df.select("doc_id", "text").collect():
        ids = theirs.encode_ordinary(text or "")
        assert got[doc] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def audit_brute(rows, least, top):
    """rows: (doc_id, text, lang, source)."""
    docs, n, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [bytes(t) for t in re.findall(rb"[a-z\x80-\xff]+", (text or "").encode().lower())]
        docs[lang].update(set(terms))
        n[lang, source].update(terms)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, c in docs[lang].items() if c >= least)
        mine = [g for g in groups if g[0] == lang]
        count = {g: [n[g][t] for t in kept] for g in mine}
        whole = [sum(c) for c in zip(*count.values())] if kept else []

        def shares(c, kept=kept):
            return [1 + 1_000_000_000 * (x + 5) // (sum(c) + 5 * len(kept)) for x in c]

        p, q = {g: shares(count[g]) for g in mine}, shares(whole)
        for g in mine:
            pairs = sorted((-sum(abs(a - b) for a, b in zip(p[g], p[h])), h[1].encode()) for h in mine if h != g)
            out |= {(*g, "pair", item.decode(), -v, i) for i, (v, item) in enumerate(pairs, 1)}
            terms = sorted((b - a, t) for t, a, b, c in zip(kept, p[g], q, count[g]) if c > 0 and a > b)
            out |= {(*g, "term", t.decode(), -v, i) for i, (v, t) in enumerate(terms[:top], 1)}
    return out


@pytest.mark.parametrize("players", [1, 2, 3, 6, 7, 12])
def test_every_two_players_meet_once(spark, players):
    even = players + players % 2
    rows = spark.range(players).withColumnRenamed("id", "slot").withColumn("players", F.lit(even).cast("long"))
    met = []
    for first in range(0, even - 1, 3):
        games = rows.withColumn("round", F.explode(divergence._rounds(first, 3)))
        met += games.select("slot", divergence.opponent(F.col("slot"), F.col("round"), F.col("players")).alias("other")).where(F.col("other") < players).collect()
    assert Counter(map(tuple, met)) == Counter((a, b) for a in range(players) for b in range(players) if a != b)


@pytest.mark.parametrize("blocks,sweep", [(3, 1), (7, 2), (4096, 8)])
def test_audit_matches_brute_force(spark, blocks, sweep):
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choice(["alpha", "Beta", "éa", "ÉA", "x1y", "zeta", "ünï", "the", "w" * 70]) for _ in range(draw.randrange(40))), "en", f"s{draw.randrange(5)}") for i in range(80)]
    rows += H.odd_rows() + [(100, "alpha", "xx", "only"), (101, "", "yy", "a"), (102, None, "yy", "b"), (103, None, None, None)]
    got = [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in divergence.audit(H.documents(spark, rows), 2, 4, blocks, sweep).collect()]
    assert len(got) == len(set(got)) and set(got) == audit_brute(rows, 2, 4)
    assert divergence.audit(H.documents(spark, [])).collect() == []


def test_share_beyond_64_bits():
    n, total = np.array([0, 10**15, 3 * 10**15]), 3 * 10**15
    assert divergence.share(n, total, 10).tolist() == [1 + 10**9 * (int(x) + 5) // (total + 50) for x in n]


def test_nearest_entries_are_exact_and_pruned():
    draw = np.random.default_rng(2)
    for k, spread in ((1, 9), (5, 3), (16, 40), (256, 4000)):
        book, parts = draw.integers(-spread, spread, (k, 8)), draw.integers(-spread, spread, (500, 8))
        book[k // 2] = book[0]  # a tie goes to the lower index
        entry, best, evaluated = codes.nearest(parts, book)
        every = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
        assert (entry == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all() and evaluated <= every.size
    # norms that spread: most entries lie outside the annulus
    book = np.outer(np.arange(1, 65) * 1000, np.ones(8, np.int64))
    parts = book[draw.integers(0, 64, 400)] + draw.integers(-50, 50, (400, 8))
    assert codes.nearest(parts, book)[2] < 0.1 * 400 * 64


def compress_brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, label, [int(np.floor(4096 * float(x))) for x in v]) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    first = {}
    for i, _, v in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2])):
        first.setdefault(i, v)
    d = len(next(iter(first.values()))) // parts
    kept = [r for r in kept if len(r[2]) == d * parts]
    books = [[v[p * d : p * d + d] for v in list(first.values())[:entries]] for p in range(parts)]

    def assign(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * d : p * d + d], e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            got = defaultdict(list)
            for _, _, v in kept:
                got[assign(p, v)[1]].append(v[p * d : p * d + d])
            for k, vs in got.items():
                books[p][k] = [sum(c) // len(vs) for c in zip(*vs)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [(i, label, [assign(p, v) for p in range(parts)]) for i, label, v in kept]
    of_label = Counter()
    for _, label, a in found:
        of_label[label] += sum(x for x, _ in a)
    return Counter((i, "".join(f"{k:02x}" for _, k in a), sum(x for x, _ in a), of_label[label], digest) for i, label, a in found)


def test_codes_of_odd_rows(spark):
    draw = np.random.default_rng(6)
    rows = [(i, draw.normal(size=16).tolist(), int(i % 3)) for i in range(40)]
    rows += [(7, rows[7][1], 1), (7, rows[8][1], None), (None, rows[3][1], None), (50, None, 1), (51, [0.0] * 16, 2), (52, [None] + [0.0] * 15, 2)]
    rows += [(53, [float("nan")] * 16, 2), (54, [float("inf")] + [0.0] * 15, 2), (55, [1.0, 2.0], 0), (56, [], 0), (57, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("code", F.lit("x")).withColumn("of", F.lit(1))
    got = codes.compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert Counter(map(tuple, got.collect())) == compress_brute(rows)
    few = df.where("vec_id < 5")
    assert Counter(map(tuple, codes.compress(few).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())) == compress_brute(rows[:5])
    assert codes.compress(df.where("vec_id = 50")).collect() == [] and codes.compress(df.limit(0)).collect() == []
    with pytest.raises(Exception, match="cut into"):
        codes.compress(df, parts=5)


def test_a_repeated_query_row_asks_once(spark):
    from loomspan.llm import neighbours

    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=8).tolist(), 0) for i in range(60)]
    rows += [rows[20], rows[20], (40, rows[3][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = neighbours.search(df, recall=1.0).collect()
    by = defaultdict(list)
    for r in got:
        by[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(by) == {0, 20, 40}
    for q, mine in by.items():
        v = np.array(min(x[1] for x in rows if x[0] == q))
        best = sorted(((-float(np.dot(np.array(x[1]), v)), x[0]) for x in rows if x[0] != q))[:20]
        mine.sort()
        assert [m[0] for m in mine] == list(range(1, 21))
        assert [m[1] for m in mine] == [b[1] for b in best]
