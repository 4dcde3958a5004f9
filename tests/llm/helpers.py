"""Brute-force versions of the operators, over plain lists."""

import re
from collections import Counter, defaultdict

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return SPLIT.findall(text or "")


def lower(text):
    return (text or "").encode().lower().decode()


def documents(spark, rows, extra=True):
    """rows: (doc_id, text, lang, source). Extra columns clash with names used inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], schema)
    if extra:
        from pyspark.sql import functions as F

        for name in ("size", "component", "gram", "at", "n", "pi", "block", "first", "starts", "mark"):
            df = df.withColumn(name, F.lit("x"))
    return df


def odd_rows():
    """Nulls in every column, empty and blank texts, ties and repeated rows, one long text."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    long_ = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    return [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base.replace("mu", "mew"), None, None), (4, None, "en", "a"), (5, "", "en", None),
        (6, " \n\t ", None, "b"), (7, "one", "fr", "b"), (8, "one", "fr", "b"), (8, "one", "fr", "b"), (9, long_, "de", "c"),
        (10, long_, "de", "c"), (11, "x " + long_ + " y", "de", "c"), (None, base, "en", "a"), (12, "É É É\x85É É É", "fr", ""),
        (13, "a\nb\na\nb", "en", "a"), (14, "##### $$$ %%% &&& ||| <<< >>> ***", "en", "d"),
    ]


def component_brute(rows, n=4, percent=85):
    sets = {}
    for doc, text in rows:
        w = words(lower(text))
        if w and doc is not None:
            sets[doc] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {tuple(w)}
    label = {doc: doc for doc in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    index = defaultdict(list)
    for doc, s in sets.items():
        for g in s:
            index[g].append(doc)
    shared = Counter()
    for held in index.values():
        for i, a in enumerate(held):
            for b in held[:i]:
                shared[min(a, b), max(a, b)] += 1
    for (a, b), k in shared.items():
        if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
            x, y = sorted((root(a), root(b)))
            label[y] = x
    return {doc: (len(sets.get(doc, ())), root(doc) if doc in sets else doc) for doc, _ in rows if doc is not None}


def repeats_brute(rows, window=50):
    import hashlib

    first = {}
    held = {doc: words(text) for doc, text in rows if doc is not None}
    for doc in sorted(held):
        w = held[doc]
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), doc)
    out = {}
    for doc, w in held.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out[doc] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def quality_brute(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, cover = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            cover.update(range(i, i + 5))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(cover), failed
