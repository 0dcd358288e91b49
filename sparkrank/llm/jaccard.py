"""Jaccard join of word shingles with skipping by relations between sets.

In any order common to all sets, the first ``k`` elements that two sets of similarity ``percent`` or more share lie
among the first ``n - ceil(percent * n) + k`` of each. This is used twice. In the order of the hashes, with a ``k`` that grows with the
set, it tells which sets can have a partner at all. For those, all elements are counted, and in the order "found once, found in few sets,
found in many" the elements found once come first, so only sets that nearly agree reach an element that
others hold. An inverted list keeps, for each such element, its sets by size and place.

*Skipping in lists.* The entries of a list of equal size and place are one block. Two blocks are passed over as a whole when
their sizes or what lies behind their places can't give the overlap needed. A long list is dealt over cells.

*Skipping by answers.* Each set is first compared with one similar set, its pivot: the one, among sets of like size in its lists,
before whose elements the fewest rare ones stand. The answer is kept as what to take off the pivot and what to add.
Sets linked to a pivot are one component, and pairs in one component are never formed again. A further pair of
sets with one pivot gets its overlap from these differences alone, without the sets.

Equal sets are one entry from the start. Elements are hashes of 64 bits, sets are told apart by 128 bits. Which elements
were found how often travels as a filter of counted size (at most ``2**MOST_BITS`` bits); a false hit only moves an element in the common order.

Defined cases: null and empty texts have empty sets, linked with nothing; of a text with fewer words than a shingle
the whole sequence is its one element; repeated rows and ids get equal rows; a null ``doc_id`` is never the smallest
of a component, a component without ids has null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.common import drop_stored, phrase_hashes, record, release, slices, sorted_groups, stored, utf8
from sparkrank.llm.components import components

WORDS = 4
PERCENT = 85
MANY = 64  # an element in more sets than this comes last
CELL = 4096  # entries of one list in a cell
LEAST_BITS, MOST_BITS = 20, 28
BATCH_BYTES = 4 << 20

GAPS = b" \t\n\x0b\x0c\r"
END = b"\xff"  # in no text, as it is not UTF-8
PLAIN = bytes.maketrans(bytes(range(65, 91)) + GAPS, bytes(range(97, 123)) + b" " * len(GAPS))


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The distinct hashes of the shingles of each text, in order."""
    data = b"".join(t.translate(PLAIN) + b" " + END + b" " for t in texts)
    coded = pc.split_pattern(pa.array([data], pa.large_binary()), pattern=b" ").flatten().dictionary_encode()
    numbers = coded.indices.to_numpy()
    nothing, end = (pc.index(coded.dictionary, pa.scalar(x, pa.large_binary())).as_py() for x in (b"", END))
    numbers = numbers[numbers != nothing]
    hashed = xxhash.xxh64_intdigest
    known = np.fromiter(map(hashed, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))[numbers]
    every = phrase_hashes(known, np.arange(max(len(known) - words + 1, 0)), words)
    out, start = [], 0
    for stop in np.flatnonzero(numbers == end).tolist():
        n = stop - start
        if n >= words or not n:
            out.append(np.unique(every[start : max(stop - words + 1, start)]))
        else:
            out.append(phrase_hashes(known, np.array([start]), n))
        start = stop + 1
    return out


def prefix_size(n, percent: int = PERCENT):
    """How many elements of a set of ``n`` must hold one of any set linked with it."""
    return n - (percent * n + 99) // 100 + 1


def agreeing(n, percent: int = PERCENT):
    """How many elements of a longer prefix of a set of ``n`` must be in any set linked with it."""
    return prefix_size(n, percent) // 2 + 1


def longer_prefix(n, agree, percent: int = PERCENT):
    """The prefix in which the first ``agree`` elements common with any linked set lie."""
    return prefix_size(n, percent) - 1 + agree


def needed(a, b, percent: int = PERCENT):
    """The least overlap of linked sets of ``a`` and ``b`` elements."""
    return -(-percent * (a + b) // (100 + percent))


def _grouped(batch: pa.RecordBatch, at: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    texts, lo, size = utf8(batch.column(at)), 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= BATCH_BYTES or i + 1 == len(texts):
            yield batch.slice(lo, i + 1 - lo), texts[lo : i + 1]
            lo, size = i + 1, 0


def _digests(sets: list[bytes]) -> np.ndarray:
    """128 bits that tell the sets apart, as two numbers each."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, sets)), "<i8").reshape(-1, 2)


PRINTS = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("first", pa.binary())])


def _prints(words: int, percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for part, texts in _grouped(batch, 2):
                sets = shingle_sets(texts, words)
                digests = _digests([s.tobytes() for s in sets])
                # long enough for what the largest set linked with this one asks for
                first = [s[: longer_prefix(len(s), agreeing(100 * len(s) // percent, percent), percent)].tobytes() if len(s) else b"" for s in sets]
                yield record(PRINTS, part.column(0), part.column(1), [len(s) for s in sets], digests[:, 0], digests[:, 1], first)

    return run


def _elements(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each element of a column of packed elements, with the number of its sets in a batch."""
    for batch in batches:
        packed = b"".join(batch.column(0).drop_null().to_pylist())
        found, n = np.unique(np.frombuffer(packed, np.int64), return_counts=True)
        yield record(pa.schema([("e", pa.int64()), ("n", pa.int64())]), found, n)


def _counted(packed: DataFrame) -> DataFrame:
    """``e, n``: elements in more than one of the packed sets."""
    return packed.mapInArrow(_elements, "e long, n long").groupBy("e").agg(F.sum("n").alias("n")).filter("n > 1")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def _marks(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Word of the filter and the four bits in it that a key sets."""
    keys = _mixed(keys)
    mask = np.zeros(len(keys), np.uint64)
    for i in range(4):
        mask |= np.uint64(1) << (keys >> np.uint64(6 * i) & np.uint64(63))
    return (keys >> np.uint64(64 - bits + 6)).astype(np.int64), mask


SEGMENTS = 64


class Filter:
    """Which distinct keys are in a set, with few false hits; its size follows the number of keys up to a bound."""

    def __init__(self, keys: DataFrame):
        keys = stored(keys, "keys")  # counted, then read
        bits = min(max((16 * keys.count()).bit_length(), LEAST_BITS), MOST_BITS)
        size = (1 << bits - 6) // SEGMENTS
        cut = pa.schema([("segment", pa.int32()), ("word", pa.int64()), ("mask", pa.int64())])

        def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                word, mask = _marks(batch.column(0).to_numpy().view(np.uint64), bits)
                yield record(cut, (word // size).astype(np.int32), word % size, mask.view(np.int64))

        def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: dict[int, np.ndarray] = {}
            for batch in batches:
                segment, word, mask = (batch.column(i).to_numpy() for i in range(3))
                for s in np.unique(segment).tolist():
                    here = segment == s
                    np.bitwise_or.at(parts.setdefault(s, np.zeros(size, np.uint64)), word[here], mask[here].view(np.uint64))
            for s, part in parts.items():
                yield record(pa.schema([("segment", pa.int32()), ("bits", pa.binary())]), [s], [part.tobytes()])

        dealt = keys.mapInArrow(places, "segment int, word long, mask long").repartition("segment")
        table = np.zeros(1 << (bits - 6), np.uint64)
        for segment, part in dealt.mapInArrow(joined, "segment int, bits binary").collect():
            table[segment * size : (segment + 1) * size] = np.frombuffer(part, np.uint64)
        drop_stored(keys)
        self.bits, self.sent = bits, keys.sparkSession.sparkContext.broadcast(table)

    def test(self):
        """A function for tasks: which of some keys may be in the set."""
        bits, sent = self.bits, self.sent

        def has(keys: np.ndarray) -> np.ndarray:
            word, mask = _marks(keys.view(np.uint64), bits)
            return sent.value[word] & mask == mask

        return has


CHOSEN = pa.schema([("key", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("elements", pa.binary())])


def _chosen_sets(has, words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            here = batch.filter(pa.array(has(batch.column(0).to_numpy())))
            for part, texts in _grouped(here, 1) if here.num_rows else ():
                sets = [s.tobytes() for s in shingle_sets(texts, words)]
                digests = _digests(sets)
                yield record(CHOSEN, part.column(0), digests[:, 0], digests[:, 1], sets)

    return run


ENTRIES = pa.schema([("e", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("place", pa.int64())])


def _entries(repeated, many, percent: int):
    """The elements of each set that it is listed under, with their place in the common order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            sets = [np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist()]
            every = np.concatenate(sets)
            level = repeated(every).astype(np.int8)
            level += many(every) & (level > 0)
            out, at = [], 0
            for id_, own in zip(batch.column(0).to_pylist(), sets, strict=True):
                rank = level[at : at + len(own)]
                at += len(own)
                order = np.argsort(rank, kind="stable")[: prefix_size(len(own), percent)]
                place = np.flatnonzero(rank[order] > 0)
                out.append((own[order[place]].view(np.int64), np.full(len(place), id_), np.full(len(place), len(own)), place))
            yield record(ENTRIES, *(np.concatenate(c) for c in zip(*out, strict=True)))

    return run


DIFFERENCE = "id long, pivot long, size long, less binary, more binary, linked boolean"
ANSWERS = pa.schema([("id", pa.int64()), ("pivot", pa.int64()), ("size", pa.int64()), ("less", pa.binary()), ("more", pa.binary()), ("linked", pa.bool_())])


def _compare(percent: int):
    """Sets against their pivots: what to take off the pivot, what to add, and whether both are linked."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for id_, pivot, own, other in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                a, b = np.frombuffer(own, np.uint64), np.frombuffer(other, np.uint64)
                less, more = np.setdiff1d(b, a, assume_unique=True), np.setdiff1d(a, b, assume_unique=True)
                common = len(b) - len(less)
                linked = 100 * common >= percent * (len(a) + len(less))
                similar = 2 * common >= len(b)
                rows.append((id_, pivot, len(b), less.tobytes() if similar else None, more.tobytes() if similar else None, linked))
            if rows:
                yield record(ANSWERS, *zip(*rows, strict=True))

    return run


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def blocks_met(n: np.ndarray, place: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each block of a list, given by size and place, the blocks from it on that may hold linked sets; sizes ascend."""
    for i in range(len(n)):
        last = np.searchsorted(n, 100 * n[i] // percent, side="right")
        other, at = n[i:last], place[i:last]
        rest = np.minimum(n[i] - place[i], other - at)
        yield i, i + np.flatnonzero(rest >= needed(n[i], other, percent))


def _pairs(percent: int):
    """Pairs of sets of different components that meet in a list, their blocks passing the filters."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            found = np.unique(np.concatenate(held), axis=0)
            return record(PAIRS, found[:, 0], found[:, 1])

        for group in sorted_groups(batches, ["e", "ci", "cj"]):
            for x, y in list_pairs(group, percent):
                a, b = group["id"][x], group["id"][y]
                held.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
                size += len(a)
                if size >= 500_000:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    return run


SHORT = 64  # entries of a list that are compared without blocks


def list_pairs(group: dict[str, np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the entries of a list, sorted by size and place, whose sets may be linked and are in different components."""
    n, place, root, block = (group[c] for c in ("n", "place", "root", "block"))
    apart = group["ci"][0] != group["cj"][0]

    def kept(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = root[x] != root[y]
        if apart:  # entries of one side were compared in their own cell
            keep &= block[x] != block[y]
        return x[keep], y[keep]

    if len(n) <= SHORT:
        x, y = kept(*np.triu_indices(len(n), 1))
        near = 100 * n[x] >= percent * n[y]
        near &= np.minimum(n[x] - place[x], n[y] - place[y]) >= needed(n[x], n[y], percent)
        yield x[near], y[near]
        return
    # entries of equal size and place are a block
    new = np.append(True, (np.diff(n) != 0) | (np.diff(place) != 0))
    first = np.append(np.flatnonzero(new), len(new))
    for i, met in blocks_met(n[first[:-1]], place[first[:-1]], percent):
        if not len(met):
            continue
        spans = [np.arange(first[j], first[j + 1]) for j in met.tolist()]
        other = np.concatenate(spans)
        own = np.arange(first[i], first[i + 1])
        step = max(1, (1 << 20) // len(other))
        for k in range(0, len(own), step):
            x, y = (v.ravel() for v in np.meshgrid(own[k : k + step], other, indexing="ij"))
            later = x < y
            yield kept(x[later], y[later])


def _dealt(entries: DataFrame, cell: int) -> DataFrame:
    """Entries of lists with different components, long lists dealt over cells that together hold all pairs."""
    lists = entries.groupBy("e").agg(F.count("*").alias("m"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    met = entries.join(stored(lists.select("e", "m"), "lists"), "e")
    blocks = F.ceil(F.col("m") / cell).cast("int")
    met = met.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select("e", F.least("block", "other").alias("ci"), F.greatest("block", "other").alias("cj"), "n", "place", "id", "root", "block")


def _linked_by_sets(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for own, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(own, np.uint64), np.frombuffer(other, np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def overlap(size: int, less: tuple[bytes, bytes], more: tuple[bytes, bytes]) -> tuple[int, int]:
    """Elements common to two sets and those of either, from their differences to one pivot of ``size`` elements."""
    less_a, less_b, more_a, more_b = (np.frombuffer(x, np.uint64) for x in (*less, *more))
    off = len(np.intersect1d(less_a, less_b, assume_unique=True))
    common = size - (len(less_a) + len(less_b) - off) + len(np.intersect1d(more_a, more_b, assume_unique=True))
    both = 2 * size - len(less_a) - len(less_b) + len(more_a) + len(more_b)
    return common, both - common


def _linked_by_differences(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for size, *parts in zip(*(batch.column(i).to_pylist() for i in range(2, 7)), strict=True):
                common, either = overlap(size, parts[:2], parts[2:])
                keep.append(100 * common >= percent * either)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _classes(prints: DataFrame) -> DataFrame:
    """``d1, d2, n, key, least, id``: one row for each distinct set that is not empty."""
    by = prints.filter("n > 0").groupBy("d1", "d2", "n")
    classes = by.agg(F.min("key").alias("key"), F.min("doc_id").alias("least"))
    return stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")


def _has_met(has, percent: int):
    """Keys of sets that agree with other sets in as many elements of their prefix as linked sets do."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            first = [np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist()]
            bounds = np.cumsum([0, *map(len, first)])
            hits = np.append(0, np.cumsum(has(np.concatenate(first))))
            n = batch.column(2).to_numpy()
            agree = agreeing(n, percent)
            ends = np.minimum(bounds[:-1] + longer_prefix(n, agree, percent), bounds[1:])
            yield batch.select([0]).filter(pa.array((n > 0) & (hits[ends] - hits[bounds[:-1]] >= agree)))

    return run


def links(sets: DataFrame, percent: int = PERCENT, many: int = MANY, cell: int = CELL) -> DataFrame:
    """``a, b``: links of distinct sets (``id, elements``) that join the same components as all links do."""
    frequent = stored(_counted(sets.select("elements")), "frequent")
    repeated, often = Filter(frequent.select("e")).test(), Filter(frequent.filter(F.col("n") > many).select("e")).test()
    drop_stored(frequent)
    entries = sets.select("id", "elements").mapInArrow(_entries(repeated, often, percent), "e long, id long, n long, place long")
    entries = stored(entries, "unlisted")
    lists = stored(entries.groupBy("e").agg(F.count("*").alias("m")).filter("m > 1").select("e"), "lists")
    entries = stored(entries.join(lists, "e"), "entries")

    # one pivot for each set: of those its lists name, the one named most often
    like = F.floor(F.log("n") / F.lit(float(np.log(100 / percent)))).alias("like")
    pivots = entries.groupBy("e", like).agg(F.min(F.struct("place", "n", "id")).alias("p")).select("e", "like", F.col("p.id").alias("pivot"))
    named = entries.select("e", like, "id").join(stored(pivots, "pivots"), ["e", "like"]).filter("id <> pivot")
    votes = named.groupBy("id", "pivot").agg(F.count("*").alias("votes"))
    chosen = stored(votes.groupBy("id").agg(F.max(F.struct("votes", "pivot")).alias("p")).select("id", F.col("p.pivot").alias("pivot")), "chosen")
    other = sets.select(F.col("id").alias("pivot"), F.col("elements").alias("other"))
    both = sets.join(chosen, "id").join(other, "pivot").select("id", "pivot", "elements", "other")
    answers = stored(both.mapInArrow(_compare(percent), DIFFERENCE), "answers")
    found = answers.filter("linked").select(F.col("id").alias("a"), F.col("pivot").alias("b"))

    # pairs of what is not one component yet
    roots = stored(components(found), "roots")
    rooted = entries.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    rooted = stored(rooted, "rooted")
    keys = ["e", "ci", "cj"]
    cells = _dealt(rooted, cell).repartition(*keys).sortWithinPartitions(*keys, "n", "place")
    pairs = stored(cells.mapInArrow(_pairs(percent), "a long, b long").distinct(), "pairs")
    drop_stored(rooted)
    # a pivot differs from itself in nothing
    kept = answers.filter("less is not null").select("id", "pivot", "size", "less", "more")
    sizes = kept.groupBy("pivot").agg(F.first("size").alias("size"))
    empty = F.lit(b"")
    selves = sizes.select(F.col("pivot").alias("id"), "pivot", "size", empty.alias("less"), empty.alias("more"))
    known = stored(kept.join(sizes.select(F.col("pivot").alias("id")), "id", "left_anti").union(selves), "differences")

    def side(name: str) -> DataFrame:
        return known.select(F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("pivot", "size", "less", "more")])

    told = pairs.join(side("a").drop("less_a", "more_a"), "a", "left").join(side("b").select("b", "pivot_b"), "b", "left")
    told = stored(told.select("a", "b", F.coalesce(F.col("pivot_a") == F.col("pivot_b"), F.lit(False)).alias("alike")), "told")
    near = told.filter("alike").join(side("a"), "a").join(side("b"), "b").select("a", "b", "size_a", "less_a", "less_b", "more_a", "more_b")
    far = told.filter("not alike").join(sets.select(F.col("id").alias("a"), F.col("elements").alias("x")), "a")
    far = far.join(sets.select(F.col("id").alias("b"), F.col("elements").alias("y")), "b").select("a", "b", "x", "y")
    return found.union(near.mapInArrow(_linked_by_differences(percent), "a long, b long")).union(far.mapInArrow(_linked_by_sets(percent), "a long, b long"))


def similar_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, many: int = MANY, cell: int = CELL) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``: the smallest document reachable by links.

    Documents link when their sets of ``words``-word shingles have a Jaccard similarity of ``percent`` / 100 or more.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    texts = texts.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    wide = stored(texts.mapInArrow(_prints(words, percent), "key long, doc_id long, n long, d1 long, d2 long, first binary"), "wide")
    # copies count here, too: they only let more sets pass
    met = Filter(_counted(wide.select("first")).select("e")).test()
    passed = wide.select("key", "first", "n").mapInArrow(_has_met(met, percent), "key long").distinct()
    prints = stored(wide.drop("first"), "prints")
    classes = _classes(prints)
    active = stored(passed.join(classes.select("key"), "key", "left_semi"), "active")
    drop_stored(wide)
    mine = texts.select("key", "text").mapInArrow(_chosen_sets(Filter(active).test(), words), "key long, d1 long, d2 long, elements binary")
    ids = stored(active.join(classes.select("key", "d1", "d2", "id"), "key"), "ids")
    sets = stored(mine.join(ids, ["key", "d1", "d2"]).dropDuplicates(["id"]).select("id", "elements"), "sets")
    roots = components(links(sets, percent, many, cell))
    named = classes.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    named = stored(named.select("d1", "d2", "n", "root", "least"), "named")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = stored(named.join(smallest, "root").select("d1", "d2", "n", "component_id"), "labels")
    rows = prints.select("doc_id", "d1", "d2", "n").join(labels, ["d1", "d2", "n"], "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
