"""Transcript sets: duplicates, fragments, main and alternate classes, keep and drop rules, public tables."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.session import stored

#: Batches for Python are bounded in bytes: texts may be long.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def duplicates(sequences: DataFrame) -> DataFrame:
    """One row a distinct sequence: key (its digest), first id and copies. Only digests are shuffled."""
    key = F.sha2(F.col("seq"), 256).alias("key")
    return sequences.select("id", key).groupBy("key").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))


def reassigned(rows: DataFrame, gain: int = 5) -> DataFrame:
    """Representative of each group: the first id, replaced whenever a later one's pcds is higher by gain or more.

    rows: key, id, pcds (whole percent). The bar only rises, so of equal pcds the first id decides; a group folds over
    at most one entry a percent point.
    """
    each = rows.groupBy("key", "pcds").agg(F.min("id").alias("id"))
    entries = F.sort_array(F.collect_list(F.struct("id", "pcds")))
    first = F.struct(F.lit(None).cast("long").alias("id"), F.lit(-1000).cast("long").alias("pcds"))
    step = lambda best, x: F.when(x["pcds"] >= best["pcds"] + gain, F.struct(x["id"].cast("long").alias("id"), x["pcds"].cast("long").alias("pcds"))).otherwise(best)
    folded = each.groupBy("key").agg(F.aggregate(entries, first, step).alias("best"))
    return folded.select("key", F.col("best.id").alias("id"), F.col("best.pcds").alias("pcds"))


_BASE, _SIZE, _CHUNK, _BLOCK = 0x9E3779B97F4A7C15, np.uint64(0xA0761D6478BD642F), 1 << 18, 17
#: What a run of letters is marked as: a beginning or an end of k letters, a whole sequence (two marks), then a beginning and an end of each class of sizes.
_BEGINS, _ENDS, _WHOLE, _CLASSES = 0, 1, (2, 3), 4
_KINDS = np.random.default_rng(24).integers(0, 1 << 63, 128, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base modulo 2**64, and of its inverse."""
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class _Runs:
    """Texts laid end to end, of which the hash of any run of letters is told by two sums (polynomials modulo 2**64)."""

    def __init__(self, texts: list[str]):
        self.codes = codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        up, self.down = _powers(1 << len(codes).bit_length())
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes + np.uint64(1)) * up[: len(codes)], out=self.sums[1:])
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes

    def hashes(self, begin, end, more=None) -> np.ndarray:
        """Mixed hashes of the runs from begin to end, both given as places or as slices; more tells apart what else is equal."""
        out = (self.sums[end] - self.sums[begin]) * self.down[begin]
        if more is not None:
            out += more
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(29))

    def whole(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.hashes(begin, end, (end - begin).astype(np.uint64) * _SIZE)


def _first_alike(runs: _Runs, begin: np.ndarray, room: np.ndarray, size: int) -> np.ndarray:
    """Whether each begin counts: not, if an earlier one of its text goes on alike for all letters that a run of less than 2 * size may have.

    In a text that repeats itself nearly all of them do. It is enough to ask the one before that has the same first letters: it has more room.
    """
    end = begin + room
    order = np.lexsort((begin, runs.hashes(begin, begin + size), end))
    same = np.flatnonzero(end[order[:-1]] == end[order[1:]])
    one, other = order[same], order[same + 1]
    length = np.minimum(room[other], 2 * size - 1)
    alike = (begin[one] < begin[other]) & (runs.hashes(begin[other], begin[other] + length) == runs.hashes(begin[one], np.minimum(begin[one] + length, end[one])))
    counts = np.ones(len(begin), bool)
    for a, b, n in zip(begin[one[alike]].tolist(), other[alike].tolist(), length[alike].tolist()):
        counts[b] = not np.array_equal(runs.codes[a : a + n], runs.codes[begin[b] : begin[b] + n])
    return counts


def _slots(hashes: np.ndarray, kind, bits: int) -> np.ndarray:
    """Bits that mark runs of these hashes as of a kind."""
    return ((hashes * _KINDS[kind]) >> np.uint64(64 - bits)).view(np.int64)


def _chunks(batch: pd.DataFrame):
    """ids and texts of a batch, so many at a time that they have some 256K letters."""
    ids, texts, letters = [], [], 0
    for id_, text in zip(batch["id"], batch["seq"]):
        ids.append(id_)
        texts.append(text)
        letters += len(text)
        if letters >= _CHUNK:
            yield ids, texts
            ids, texts, letters = [], [], 0
    if ids:
        yield ids, texts


def _digest(text: str) -> bytes:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()


def _marks(k: int, bits: int):
    """Sequences of k letters or more: id, key (their digest) and marks, the bits by which they are sought."""

    def run(batches):
        for batch in batches:
            for ids, texts in _chunks(batch):
                runs = _Runs(texts)
                begin, end = runs.begins, runs.ends
                level = np.frexp(runs.sizes // k)[1].astype(np.int64) - 1
                size = k << level
                outer = [(runs.hashes(begin, begin + k), _BEGINS), (runs.hashes(end - k, end), _ENDS), *[(runs.whole(begin, end), kind) for kind in _WHOLE]]
                outer += [(runs.hashes(begin, begin + size), _CLASSES + 2 * level), (runs.hashes(end - size, end), _CLASSES + 1 + 2 * level)]
                marks = np.stack([_slots(h, kind, bits) for h, kind in outer], axis=1).astype(np.int32)
                yield pd.DataFrame({"id": ids, "key": [_digest(t) for t in texts], "marks": list(marks)})

    return run


def _packed(size: int):
    """Bits of a block of 2**size of them, as bytes; so what the driver gets of a bitmap doesn't grow with the number of marks."""

    def run(key, rows):
        slot = rows["slot"].to_numpy() & ((1 << size) - 1)
        out = np.zeros(max(1, 1 << size >> 3), np.uint8)
        np.bitwise_or.at(out, slot >> 3, (1 << (slot & 7)).astype(np.uint8))
        return pd.DataFrame({"block": [key[0]], "bits": [out.tobytes()]})

    return run


def _held(runs: _Runs, k: int, bits: int, sketch: np.ndarray):
    """Runs that the sketch holds as whole sequences, but for the texts themselves: arrays of their begins and ends.

    Places are thinned out by their k letters first, so that little is left for the classes of sizes: sequences of 1 to 2 times k
    letters, of 2 to 4 times, and so on. In each a run has to begin and to end with as many letters as the class's smallest has
    (half of its own at least, so both together are all of them) like some sequence of the class, and then be one as a whole.
    """

    def has(hashes, kind):
        slot = _slots(hashes, kind, bits)
        return ((sketch[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool)

    begins, ends, last = [], [], len(runs.sums) - k
    for at in range(0, last, _CHUNK):
        to = min(at + _CHUNK, last)
        hashes = runs.hashes(slice(at, to), slice(at + k, to + k))
        begins.append(np.flatnonzero(has(hashes, _BEGINS)) + at)
        ends.append(np.flatnonzero(has(hashes, _ENDS)) + at + k)
    if not begins:
        return
    begins, ends = np.concatenate(begins), np.concatenate(ends)
    # letters of the same text from a place on, and up to it
    text = np.searchsorted(runs.ends, begins, "right")
    after, first = runs.ends[text] - begins, runs.begins[text] == begins
    before = ends - runs.begins[np.searchsorted(runs.ends, ends)]
    for level in range((len(_KINDS) - _CLASSES) // 2):
        size = k << level
        far = after >= size
        begins, after, first = begins[far], after[far], first[far]
        far = before >= size
        ends, before = ends[far], before[far]
        if not len(begins) or not len(ends):
            return
        hit = has(runs.hashes(begins, begins + size), _CLASSES + 2 * level)
        begin, room, outer = begins[hit], after[hit], first[hit]
        end = ends[has(runs.hashes(ends - size, ends), _CLASSES + 1 + 2 * level)]
        low = np.searchsorted(end, begin + size)
        many = np.searchsorted(end, begin + np.minimum(room, 2 * size - 1), "right") - low
        if many.sum() > _CHUNK:
            counts = _first_alike(runs, begin, room, size)
            begin, room, outer, low, many = (x[counts] for x in (begin, room, outer, low, many))
        upto = np.cumsum(many)
        at = 0
        while at < len(begin):
            to = max(at + 1, int(np.searchsorted(upto, upto[at] - many[at] + _CHUNK, "right")))
            n = many[at:to]
            b = np.repeat(begin[at:to], n)
            e = end[np.repeat(low[at:to] - np.cumsum(n) + n, n) + np.arange(len(b))]
            hashes = runs.whole(b, e)
            hit = np.flatnonzero(has(hashes, _WHOLE[0]) & ~(np.repeat(outer[at:to], n) & (e - b == np.repeat(room[at:to], n))))
            hit = hit[has(hashes[hit], _WHOLE[1])]
            yield b[hit], e[hit]
            at = to


def _words(k: int, bits: int, sketch):
    """Digests of the runs of letters that the sketch holds as whole sequences, each with the smallest id of a batch: id, key."""

    def run(batches):
        for batch in batches:
            least = {}
            for ids, texts in _chunks(batch):
                runs = _Runs(texts)
                for begin, end in _held(runs, k, bits, sketch.value):
                    text = np.searchsorted(runs.ends, begin, "right")
                    for t, b, e in zip(text.tolist(), (begin - runs.begins[text]).tolist(), (end - runs.begins[text]).tolist()):
                        # short runs are found often: their letters are told apart at less cost than by a digest each time
                        word = texts[t][b:e] if e - b < 256 else _digest(texts[t][b:e])
                        if word not in least or ids[t] < least[word]:
                            least[word] = ids[t]
            if least:
                yield pd.DataFrame({"id": list(least.values()), "key": [_digest(w) if isinstance(w, str) else w for w in least]})

    return run


def fragments(sequences: DataFrame, k: int = 24, bits: int = 27) -> DataFrame:
    """(id, holder): sequences that a longer one holds whole, with the smallest such id.

    Texts are looked through where they lie. A bitmap of fixed size (2**bits bits) knows the hashes of all sequences and of their beginnings
    and ends, so of a text's runs of letters those alone leave a task that are a sequence as a whole; runs that share a bit cost time,
    not results. The digest of their letters decides. A task sends a run's digest once a batch, however many sequences begin
    alike or hold it. Sequences shorter than k take no part.
    """
    rows = sequences.where((F.length("seq") >= k) & F.col("id").isNotNull()).select("id", "seq")
    kind = sequences.schema["id"].dataType.simpleString()
    keys = stored(rows.mapInPandas(_marks(k, bits), f"id {kind}, key binary, marks array<int>"), "sought", BATCHES)
    block = min(bits, _BLOCK)
    # many sequences begin alike: their marks are one before they are dealt by block
    marks = keys.select(F.explode("marks").alias("slot")).distinct().groupBy(F.shiftright("slot", block).alias("block"))
    bitmap = np.zeros((1 << (bits - block), max(1, 1 << block >> 3)), np.uint8)
    for row in marks.applyInPandas(_packed(block), "block int, bits binary").toArrow().to_pylist():
        bitmap[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    sketch = sequences.sparkSession.sparkContext.broadcast(bitmap.reshape(-1))
    holders = stored(rows.mapInPandas(_words(k, bits, sketch), f"id {kind}, key binary").groupBy("key").agg(F.min("id").alias("holder")), "holders", BATCHES)
    return keys.select("id", "key").join(holders, "key").groupBy("id").agg(F.min("holder").alias("holder"))


# Least percent identity of each class, and the alignment share below which there is none.
HIGH, MIDDLE, LOW, TINY = 99, 90, 80, 25


def pair_class(pid, pal, q_len, t_len) -> str | None:
    """Class of the shorter sequence of a pair."""
    if pal < TINY or pid < LOW:
        return None
    if t_len <= 0:
        return "frag0aa"
    if pid >= HIGH:
        kind = "parthi" if t_len < 0.5 * q_len else "althi"
        return kind + ("1" if pal >= 98 or 0 <= t_len * (100 - pal) / 100 < 9 else "")
    return ("altmid" if pid >= MIDDLE else "altlo") + ("frag" if t_len < 0.5 * q_len else "")


def class_of_pair(pid: Column, pal: Column, q_len: Column, t_len: Column) -> Column:
    """pair_class as an expression."""
    suffix = F.when((pal >= 98) | (t_len * (100 - pal) / 100 < 9), "1").otherwise("")
    high = F.concat(F.when(t_len < 0.5 * q_len, "parthi").otherwise("althi"), suffix)
    lower = F.concat(F.when(pid >= MIDDLE, "altmid").otherwise("altlo"), F.when(t_len < 0.5 * q_len, "frag").otherwise(""))
    return F.when((pal < TINY) | (pid < LOW), None).when(t_len <= 0, "frag0aa").when(pid >= HIGH, high).otherwise(lower)


def percents(rows: DataFrame) -> DataFrame:
    """Adds pid and pal: whole percents of identity and of the shorter sequence, halves being added to the counts."""
    pid = F.floor(100 * (0.5 + F.col("ident")) / F.col("aln")).cast("long")
    pal = F.least(F.lit(100), F.floor(100 * (0.5 + F.col("aln")) / F.greatest(F.lit(1), F.least("q_len", "t_len")))).cast("long")
    return rows.withColumn("pid", pid).withColumn("pal", pal)


def classes(pairs: DataFrame, components: DataFrame | None = None) -> DataFrame:
    """Identity classes: id, class, main, pid, pal. pairs: q, q_len, t, t_len, aln, ident.

    components is not needed any more: the order matters among linked pairs only, and rounds of joins keep it.
    """
    from .classes import identity_classes

    return identity_classes(pairs)


def poor_bits(aa: Column, pcds: Column, duplicate: Column, gaps: Column, least: int = 40) -> Column:
    """Sum of: 1 tiny, 2 bad ends, 4 poor ends, 8 duplicate protein, 16 many gaps."""
    return (
        F.when(aa < least, 1).otherwise(0) + F.when(pcds < 35, 2).otherwise(0) + F.when((pcds >= 35) & (pcds < 60), 4).otherwise(0)
        + F.when(duplicate, 8).otherwise(0) + F.when(10 * gaps > aa, 16).otherwise(0)
    )


def keep_or_drop(bits: Column, class_: Column, rescued: Column, aa: Column, large: int = 200) -> Column:
    """okay, drop or maybeok: a match to a reference or a large protein outweighs poor bits; fragments need none."""
    return (
        F.when(rescued | (aa >= large), "okay").when(class_.startswith("parthi") & (bits > 0), "drop").when(bits == 0, "okay")
        .when(bits.bitwiseAND(1 + 2 + 8) > 0, "drop").otherwise("maybeok")
    )


def public_table(rows: DataFrame, prefix: str) -> DataFrame:
    """Public ids of genes and their alternates. rows: id, main, size. Genes go by main size, alternates by own size.

    Gene numbers are global, so they come from one sort of the genes' sizes, counted by range before rows are numbered.
    """
    from loomspan.functions.names import public_id

    genes = rows.groupBy("main").agg(F.max(F.when(F.col("id") == F.col("main"), F.col("size"))).alias("main_size"))
    size = F.coalesce("main_size", F.lit(-1))
    counts = genes.groupBy(size.alias("s")).agg(F.count("*").alias("n"))
    before = counts.select("s", (F.sum("n").over(Window.orderBy(F.desc("s"))) - F.col("n")).alias("before"))  # one row a size
    own = F.row_number().over(Window.partitionBy("s").orderBy("main"))
    numbered = genes.withColumn("s", size).join(before, "s").withColumn("gene", F.col("before") + own).select("main", "gene")
    is_main = (F.col("id") == F.col("main")).cast("int")
    alt = F.row_number().over(Window.partitionBy("main").orderBy(F.desc(is_main), F.desc("size"), "id"))
    out = rows.join(numbered, "main").withColumn("alt", alt)
    return out.select("id", "main", F.col("gene").cast("long").alias("gene"), F.col("alt").cast("long").alias("alt"), public_id(prefix, F.col("gene"), F.col("alt")).alias("public_id"))


def reclassified(rows: DataFrame, most_same: int = 3) -> DataFrame:
    """Alternates of each gene kept or dropped. rows: gene, id, score, size, complete (bool), same_cds (bool), good (bool).

    The best by score (ties by id) is main. An alternate goes if it is less complete, under 0.9 of the main's size and
    of the same coding sequence or not, or as complete, of the same coding sequence and under 0.4; good ones stay.
    Beyond most_same kept alternates, those within 12 of the one before by size go.
    """
    by = Window.partitionBy("gene").orderBy(F.desc("score"), "id")
    rows = rows.withColumn("rank", F.row_number().over(by)).withColumn("main", F.first(F.struct("size", "complete")).over(by))
    small = lambda share: F.col("size") < share * F.col("main.size")
    less = ~F.col("complete") & F.col("main.complete")
    bad = (less & small(0.9)) | (~less & F.col("same_cds") & small(0.4))
    rows = rows.withColumn("kept", (F.col("rank") == 1) | F.col("good") | ~bad)
    order = Window.partitionBy("gene", "kept").orderBy("rank")
    number, before = F.row_number().over(order), F.lag("size").over(order)
    rows = rows.withColumn("number", number).withColumn("close", F.abs(F.col("size") - before) <= 12)
    excess = F.col("kept") & (F.col("number") > most_same + 1) & F.coalesce("close", F.lit(False)) & ~F.col("good")
    return rows.select("gene", "id", F.col("rank").cast("long").alias("rank"), (F.col("kept") & ~excess).alias("kept"))
