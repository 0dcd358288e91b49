"""Phrases whose words belong together, grown best first from counted prefixes.

A phrase of ``a`` occurrences, cut after its first ``k`` words into parts of ``l`` and ``r``
occurrences, scores ``2 * scale * a / (l + r)`` at its lowest cut. For every longer phrase that begins
with ``p``, its count is at most ``f(p)`` and the part behind the cut is at least as frequent as the phrase, so

    score <= U(p) = min over the cuts of p of 2 * scale * f(p) / (f(first part) + f(p))

and likewise ``V`` from the suffixes. A limit ``t`` for each language makes the frontier: pairs
of words are counted once, and then only those phrases are counted whose prefix has ``U >= t`` or whose suffix
has ``V >= t``. All phrases of score ``t`` or more are then known with all their parts, and so is every
phrase that is longer by one word than one of them, which decides on dropping it (a longer phrase
that drops it holds one that is longer by one word and at least as frequent). When a language has
enough surviving phrases of score ``t`` or more, everything up to its last score with its ties is settled;
otherwise its limit falls to where four times as many pairs lie, and at last to 0, where everything is grown.

Counting is one scan of the texts for each length. A task names words by numbers, so phrases
are counted exactly as packed numbers, and hands on each phrase of its part of the texts once; sums are
combined before the shuffle. What is on the frontier travels as a bitmap of fixed size (``2**bits`` bits). A phrase
that meets a bit by chance is counted in vain, but in full, so the counts are exact in any case.

Defined cases: null and empty texts have no words; a null language is ``und``; repeated rows count each; an
empty table gives no rows; a language with fewer surviving phrases returns them all; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkrank.llm.common import drop_stored, phrase_hashes, record, release, slices, stored, utf8

LEAST = 30
LONGEST = 4
TOP = 2000
SHARE = 80
SCALE = 1_000_000
BITS = 26
CHUNK = 4 << 20  # bytes of texts that are counted together in a task
GROUPS = 64  # groups of a language whose best phrases are found before the last step

# The separators of pieces and of words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
GAPS = b" \t"
END = b"\xff"
TO_LOWER = bytes.maketrans(bytes(range(65, 91)) + PIECE_ENDS + GAPS, bytes(range(97, 123)) + b"\n" * len(PIECE_ENDS) + b" " * len(GAPS))


def word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang))


def met(bitmap: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which of the numbers have their bit set."""
    place = found >> np.uint64(64 - int(len(bitmap) * 64).bit_length() + 1)
    return bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1) != 0


def packed(numbers: np.ndarray, at: np.ndarray, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct phrases of ``size`` words at the places, as columns of word numbers, and how often they stand there."""
    width = max(int(numbers.max(initial=0)).bit_length(), int(len(at)).bit_length())
    code, fields, tables = numbers[at].astype(np.int64), 1, []
    for j in range(1, size):
        if (fields + 1) * width > 62:  # the number is full: number what there is
            known, code = np.unique(code, return_inverse=True)
            tables.append((known, fields))
            fields = 1
        code = code << width | numbers[at + j]
        fields += 1
    code, counts = np.unique(code, return_counts=True)
    columns, mask = [], (1 << width) - 1
    while True:
        columns += [code >> width * i & mask for i in range(fields - bool(tables))]
        if not tables:
            return columns[::-1], counts
        known, of = tables.pop()
        code, fields = known[code >> width * (fields - 1)], of


class Chunk:
    """Texts of one language as numbers of their words; 0 ends a piece."""

    def __init__(self, lang: bytes, texts: list[bytes]):
        # no text holds the byte that stands for the end of a piece, as it is not UTF-8
        data = b"\n".join([*texts, b""]).translate(TO_LOWER).replace(b"\n", b" " + END + b" ")
        coded = pc.split_pattern(pa.array([data], pa.large_binary()), pattern=b" ").flatten().dictionary_encode()
        self.lang, self.words = lang, coded.dictionary
        numbers = coded.indices.to_numpy()
        nothing, end = (pc.index(self.words, pa.scalar(x, pa.large_binary())).as_py() for x in (b"", END))
        numbers = numbers[numbers != nothing]
        self.numbers = np.where(numbers == end, 0, numbers + 1)
        seed = xxhash.xxh32_intdigest(lang)
        hashed = xxhash.xxh64_intdigest
        self.hashes = np.fromiter((hashed(w, seed) for w in self.words.to_pylist()), np.uint64, len(self.words))

    def count(self, size: int, wanted) -> tuple[pa.Array, np.ndarray]:
        """Phrases of ``size`` words, of those that ``wanted`` chooses by the hashes one word shorter, and their counts."""
        inside = self.numbers > 0
        at = inside[: max(len(inside) - size + 1, 0)].copy()
        for j in range(1, size):
            at &= inside[j : j + len(at)]
        at = np.flatnonzero(at)
        if size > 1:
            if size == 2:
                shorter = phrase_hashes(self.hashes, np.arange(len(self.hashes)), 1)[self.numbers - 1]
            else:
                words = self.hashes[self.numbers - 1]
                shorter = phrase_hashes(words, np.arange(max(len(words) - size + 2, 0)), size - 1)
            at = at[wanted(shorter, at)]
        columns, counts = packed(self.numbers, at, size)
        del at, inside
        parts = [self.words.take(pa.array(c - 1)) for c in columns]
        names = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
        if size == 1:  # the number of all words, under the empty phrase
            names, counts = pa.concat_arrays([names, pa.array([b""], pa.large_binary())]), np.append(counts, np.count_nonzero(self.numbers))
        return names, counts


COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64())])


def _count(size: int, tight: bool, maps: dict):
    """Count the phrases of ``size`` words that the bitmaps ask for."""

    def wanted(shorter: np.ndarray, at: np.ndarray) -> np.ndarray:
        def has(name: str) -> tuple[np.ndarray, np.ndarray]:
            found = met(maps[name].value, shorter)
            return found[at], found[at + 1]

        if size == 2:
            return np.logical_and(*has("frequent"))
        if tight:
            return has("open")[0] & has("open_end")[1] | np.logical_or(*has("scored"))
        asked = has("open")[0] | has("open_end")[1]
        return asked & np.logical_and(*has("frequent")) if "frequent" in maps else asked

    def rows(lang: bytes, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        names, counts = Chunk(lang, texts).count(size, wanted)
        for i in range(0, len(names), 1 << 16):
            part, own = names[i : i + (1 << 16)], counts[i : i + (1 << 16)]
            yield record(COUNTED, [lang.decode()] * len(part), part.cast(pa.binary()).cast(pa.string()), own)
        del names, counts
        pa.default_memory_pool().release_unused()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: dict[bytes, list[bytes]] = {}
        sizes: dict[bytes, int] = {}
        for batch in slices(batches):
            for lang, text in zip(utf8(batch.column(0)), utf8(batch.column(1)), strict=True):
                for part in _cut(text):
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                    if sizes[lang] >= CHUNK:
                        yield from rows(lang, held.pop(lang))
                        del sizes[lang]
            if sum(sizes.values()) >= 2 * CHUNK:  # of many languages
                for lang in list(held):
                    yield from rows(lang, held.pop(lang))
                sizes.clear()
        for lang in list(held):
            yield from rows(lang, held.pop(lang))

    return run


def _cut(text: bytes, size: int = 1 << 21) -> Iterator[bytes]:
    """A long text in parts of at least ``size`` bytes, cut between pieces only.

    A part without the end of a piece grows up to the next one, so a piece is always whole.
    """
    at = 0
    while len(text) - at > size:
        ends = [e for e in (text.find(bytes([c]), at + size) for c in PIECE_ENDS) if e >= 0]
        if not ends:
            break
        yield text[at : min(ends)]
        at = min(ends) + 1
    yield text[at:]


def _set_bits(size: int, bits: int):
    """The places in the bitmap of phrases of ``size`` words, as numbers of 64-bit words and their bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = zip(utf8(batch.column(0)), utf8(batch.column(1)), strict=True)
            hashes = np.array([word_hash(lang, w) for lang, phrase in rows for w in phrase.split(b" ")], np.uint64)
            place = phrase_hashes(hashes, np.arange(0, len(hashes), size), size) >> np.uint64(64 - bits)
            bit = np.uint64(1) << (place & np.uint64(63))
            yield record(pa.schema([("word", pa.int64()), ("bits", pa.int64())]), (place >> np.uint64(6)).astype(np.int64), bit.view(np.int64))

    return run


def _bitmap(phrases: DataFrame, size: int, bits: int):
    """A bitmap of ``2**bits`` bits of ``lang, phrase``, sent to the workers."""
    places = phrases.select("lang", "phrase").mapInArrow(_set_bits(size, bits), "word long, bits long")
    words = places.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(out)


def _ratio(a: Column, l: Column, r: Column, scale: int) -> Column:  # noqa: E741
    """``floor(2 * scale * a / (l + r))`` in whole numbers of any size."""
    wide = lambda c: c.cast("decimal(19,0)")
    over, under = wide(a) * F.lit(2 * scale).cast("decimal(8,0)"), wide(l) + wide(r)
    # the remainder taken off first, the division is exact, so no rounding touches the result
    return ((over - over % under) / under).cast("decimal(20,0)").cast("long")


def scored(counts: DataFrame, parts: DataFrame, size: int, scale: int) -> DataFrame:
    """``lang, phrase, a, l, r, score, u, v`` of counted phrases of ``size`` words; null where a part was not counted."""
    words = F.split("phrase", " ")
    cuts = [F.struct(F.lit(k).alias("k"), F.concat_ws(" ", F.slice(words, 1, k)).alias("first"), F.concat_ws(" ", F.slice(words, k + 1, size)).alias("rest")) for k in range(1, size)]
    rows = counts.select("lang", "phrase", "a", F.explode(F.array(*cuts)).alias("c")).select("lang", "phrase", "a", "c.*")
    first = parts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    rest = parts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cut = rows.join(first, ["lang", "first"], "left").join(rest, ["lang", "rest"], "left")
    a, l, r = F.col("a"), F.col("l"), F.col("r")  # noqa: E741
    cut = cut.withColumns({"s": _ratio(a, l, r, scale), "u": _ratio(a, l, a, scale), "v": _ratio(a, a, r, scale)})

    def whole(value: str, out: str) -> Column:
        return F.when(F.count(value) == size - 1, F.min(value)).alias(out)

    lowest = F.when(F.count("s") == size - 1, F.min(F.struct("s", "k", "l", "r"))).alias("at")
    by = cut.groupBy("lang", "phrase").agg(F.first("a").alias("a"), lowest, whole("u", "u"), whole("v", "v"))
    return by.select("lang", "phrase", "a", "at.l", "at.r", F.col("at.s").alias("score"), "u", "v")


def _limits(pairs: DataFrame, wanted: int) -> DataFrame:
    """``lang, t``: the score that ``wanted`` pairs of a language reach; 0 if it has fewer."""
    steps = pairs.groupBy("lang", "score").agg(F.count("*").alias("n"))  # a score is one of few numbers
    reached = F.sum("n").over(W.partitionBy("lang").orderBy(F.col("score").desc()))
    return steps.withColumn("reached", reached).groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("reached") >= wanted, F.col("score"))), F.lit(0)).alias("t"))


def _survivors(known: list[DataFrame], limits: DataFrame, share: int) -> DataFrame:
    """Scored phrases from the limit of their language on that no longer phrase drops."""
    named = known[0]
    for more in known[1:]:
        named = named.union(more)
    candidates = named.join(limits, "lang").filter("score >= t").drop("t", "u", "v")
    if len(known) == 1:
        return candidates
    longer = known[1]
    for more in known[2:]:
        longer = longer.union(more)
    words = F.split("phrase", " ")
    inner = F.array(F.concat_ws(" ", F.slice(words, 1, F.size(words) - 1)), F.concat_ws(" ", F.slice(words, 2, F.size(words))))
    most = longer.select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    dropped = F.coalesce(wide("longer") * 100 >= wide("a") * share, F.lit(False))
    return candidates.join(most, ["lang", "phrase"], "left").filter(~dropped).drop("longer")


def collocations(
    docs: DataFrame,
    *,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    share: int = SHARE,
    scale: int = SCALE,
    bits: int = BITS,
    begin: int | None = None,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of 2 to ``longest`` words of each language.

    ``least`` occurrences make a phrase a candidate; ``share`` is the percentage of its occurrences
    that a longer candidate needs to drop it; ``begin`` is the number of pairs of words that sets
    the first limit (4 * ``top``).
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))

    def counted(size: int, maps: dict, tight: bool = False) -> DataFrame:
        rows = texts.mapInArrow(_count(size, tight, maps), "lang string, phrase string, a long")
        sums = rows.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).filter((F.col("a") >= least) | (F.col("phrase") == ""))
        out = stored(sums, f"phrases{size}")
        for m in maps.values():
            m.unpersist()
        return out

    words = counted(1, {})
    totals = words.filter("phrase = ''").select("lang", F.col("a").alias("n"))
    words = words.filter((F.col("phrase") != "") & (F.col("a") >= least))
    pairs = counted(2, {"frequent": _bitmap(words, 1, bits)}) if longest > 1 else words.filter("false")
    pairs_scored = stored(scored(pairs, words, 2, scale), "pairs")
    wanted, done = begin or 4 * top, []
    limits = stored(_limits(pairs_scored, wanted), "limits")
    while not limits.isEmpty():
        known, parts = [pairs_scored], words.union(pairs)
        made = []
        for size in range(3, longest + 1):
            shorter = known[-1].join(limits, "lang")
            tight = size == longest
            maps = {"open": _bitmap(shorter.filter("u >= t"), size - 1, bits), "open_end": _bitmap(shorter.filter("v >= t"), size - 1, bits)}
            if tight:
                maps["scored"] = _bitmap(shorter.filter("score >= t"), size - 1, bits)
            elif size == 3:
                maps["frequent"] = _bitmap(pairs, 2, bits)
            counts = counted(size, maps, tight)
            known.append(stored(scored(counts, parts, size, scale), f"scored{size}"))
            made += [counts, known[-1]]
            parts = parts.union(counts)
        alive = stored(_survivors(known, limits, share), "alive")
        # enough phrases are settled, or nothing is left to grow
        settled = limits.join(alive.groupBy("lang").agg(F.count("*").alias("alive")), "lang", "left")
        settled = settled.withColumn("settled", (F.col("t") == 0) | (F.coalesce("alive", F.lit(0)) >= top))
        ready = stored(alive.join(settled.filter("settled").select("lang"), "lang", "left_semi"), "settled")
        done.append(ready)
        wanted *= 4
        lower = _limits(pairs_scored, wanted).join(settled.filter("not settled").select("lang"), "lang", "left_semi")
        limits = stored(lower, "limits")
        for table in [*made, alive]:
            drop_stored(table)
    if not done:
        done = [stored(pairs_scored.drop("u", "v"), "settled")]
    every = done[0]
    for more in done[1:]:
        every = every.union(more)
    return _ranked(every, totals, top)


def _ranked(phrases: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    dealt = phrases.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(GROUPS)))
    first = dealt.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    best = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
