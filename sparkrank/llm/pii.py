"""Personal data by rules and by bootstrapped contextual extraction.

Rules find e-mail and IP addresses, card and phone numbers. These seed entities
induce lexical patterns: the word, or the two words, before an identifier. All
identifier-like strings of the corpus and their patterns form a graph. Spark scores
it in rounds: a pattern is as reliable as the share of its distinct instances that are known
to be of one kind, an instance as certain as its patterns together make it. What
reliable patterns extract with high confidence joins the known instances of
the next round, and all their occurrences after such patterns become spans. Spans of the rules stay.

The graph has one edge for each distinct (pattern, instance), and all steps are joins and
aggregations of edges; nothing of it passes through the driver.

Defined cases: a null text counts as empty; repeated rows and ids get equal rows; a null ``doc_id`` is kept;
an empty table gives no rows; other columns are not read (``masked`` keeps them).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrank.llm.common import release, slices, stored, strings

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_SEEDS = 3  # distinct known instances of a pattern
MIN_SCORE = 0.8

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
#: Identifier-like strings: a token with an @ or four digits, and number groups that follow it.
CANDIDATE = re.compile(r"(?<!\S)\S*[0-9@]\S*(?: [(]?[0-9][0-9().-]*){0,3}")
EDGES = "\"'`.,;:!?()[]{}<>*#$%&|=«»“”"
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain; found from the @, so long runs without one cost nothing."""
    done = 0
    at = text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at)
        following = at + 1
        if domain:
            start = at
            while start > done and text[start - 1] in LOCAL_CHARS:
                start -= 1
            if start < at:
                yield start, domain.end()
                following = done = domain.end()
        at = text.find("@", following)


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of what the rules find, sorted."""
    spans = [(a, 0, b) for a, b in emails(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_byte, m.groups()))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = "".join(DIGITS.findall(m[0]))
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(DIGITS.findall(m[0])) <= 15]
    return sorted(spans)


def shown(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _context(text: str, start: int) -> list[str]:
    """Patterns of the place before ``start``: its last word, and its last two where there are two."""
    words = text[max(0, start - 80) : start].lower().split()[-2:]
    words = [DIGITS.sub("0", w) for w in words]
    return [f"{n} " + " ".join(words[-n:]) for n in range(1, len(words) + 1)]


def candidates(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int | None, list[str]]]:
    """(start, end, kind, patterns) of seeds and of identifier-like strings that touch no seed."""
    for a, k, b in spans:
        yield a, b, k, _context(text, a)
    seeds = sorted((a, b) for a, _, b in spans)
    i = 0
    for m in CANDIDATE.finditer(text):
        token = m[0]
        a = m.start() + len(token) - len(token.lstrip(EDGES))
        b = m.end() - (len(token) - len(token.rstrip(EDGES)))
        if not 6 <= b - a <= 80 or "@" not in text[a:b] and len(DIGITS.findall(text, a, b)) < 4:
            continue
        while i < len(seeds) and seeds[i][1] <= a:
            i += 1
        if i < len(seeds) and seeds[i][0] < b:
            continue
        yield a, b, None, _context(text, a)


SEEN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])
SCANNED = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("base", pa.string()), ("seen", pa.list_(SEEN))])
SCANNED_DDL = (
    "doc_id long, key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
    "seen array<struct<start:long,end:long,kind:int,instance:string,patterns:array<string>>>"
)


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in slices(batches):
        rows = []
        for text in strings(batch.column(2)):
            spans = base_spans(text)
            line = shown(spans)
            counts = [sum(k == n for _, k, _ in spans) for n in range(len(KINDS))]
            seen = [{"start": a, "end": b, "kind": k, "instance": text[a:b].lower(), "patterns": p} for a, b, k, p in candidates(text, spans)]
            rows.append((*counts, hashlib.sha256(line.encode()).hexdigest(), line, seen))
        columns = [batch.column(0).cast(pa.int64()), batch.column(1), *(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(SCANNED)[2:], strict=True))]
        yield pa.RecordBatch.from_arrays(columns, schema=SCANNED)


def discover(edges: DataFrame, known: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE) -> tuple[DataFrame, DataFrame]:
    """Reliable patterns and discovered instances of a graph.

    ``edges`` are distinct (pattern, instance), ``known`` (instance, kind) the seeds.
    Gives (pattern, kind, reliability) and (instance, kind).
    """
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    found = known.select("instance", "kind", F.lit(1.0).alias("score"), F.lit(True).alias("seed"))
    patterns = None
    for _ in range(rounds):
        shares = edges.join(found, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("s"), F.count("*").alias("m"))
        scored = shares.filter(F.col("m") >= min_seeds).join(sizes, "pattern").select("pattern", "kind", (F.col("s") / F.col("n")).alias("reliability"))
        patterns = stored(scored.filter(F.col("reliability") >= min_score), "patterns")
        missed = F.log(1 - F.least(F.col("reliability"), F.lit(0.999)))
        certain = edges.join(patterns, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(missed))).alias("score"))
        best = Window.partitionBy("instance").orderBy(F.desc("score"), "kind")
        new = certain.filter(F.col("score") >= min_score).withColumn("r", F.row_number().over(best)).filter("r = 1").drop("r")
        new = stored(new.join(known.select("instance"), "instance", "left_anti").withColumn("seed", F.lit(False)), "discovered")
        grown = found.filter("seed").unionByName(new)
        if new.isEmpty():
            return patterns, new.select("instance", "kind")
        found = grown
    return patterns, found.filter("not seed").select("instance", "kind")


def personal_data(docs: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id, key, n_<kind>, base_sha256, spans`` for every row of ``docs``.

    ``spans`` are all spans as ``kind:start:end`` by start, then kind, in code
    points; the counts and the digest are those of the rules. ``key`` stands for id and text.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.select("doc_id", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("key"), "text")
    scanned = stored(texts.mapInArrow(_scan, SCANNED_DDL), "scanned")
    seen = scanned.select("key", F.explode("seen").alias("s")).select("key", "s.*")
    edges = stored(seen.select("instance", F.explode("patterns").alias("pattern")).distinct(), "edges")
    seeds = seen.filter("kind is not null").groupBy("instance").agg(F.min("kind").alias("kind"))
    patterns, instances = discover(edges, stored(seeds, "seeds"), rounds, min_seeds, min_score)
    unknown = seen.filter("kind is null").select("key", "start", "end", "instance", F.explode("patterns").alias("pattern")).distinct()
    added = unknown.join(patterns.select("pattern").distinct(), "pattern", "left_semi").join(instances, "instance")
    names = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    spans = added.select("key", F.struct("start", "kind", F.concat_ws(":", names, "start", "end").alias("shown")).alias("span")).distinct()
    extra = spans.groupBy("key").agg(F.collect_list("span").alias("extra"))
    old = F.transform(F.filter(F.split("base", ","), lambda x: x != ""), _parsed)
    both = F.transform(F.array_sort(F.concat(old, "extra")), lambda s: s["shown"])
    joined = scanned.drop("seen").join(extra, "key", "left")
    line = F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.array_join(both, ","))
    return joined.select("doc_id", "key", *(f"n_{k}" for k in KINDS), "base_sha256", line.alias("spans"))


def _parsed(span):
    part = lambda i: F.split(span, ":")[i]
    kind = (F.array_position(F.array(*map(F.lit, KINDS)), part(0)) - 1).cast("int")
    return F.struct(part(1).cast("long").alias("start"), kind.alias("kind"), span.alias("shown"))


def cut(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first counts."""
    out, done = [], 0
    for span in spans.split(",") if spans else ():
        kind, start, end = span.split(":")
        if int(start) >= done:
            out += [text[done : int(start)], f"[{kind.upper()}]"]
        done = max(done, int(end))
    return "".join([*out, text[done:]])


def _mask(text_at: int, spans_at: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, spans = strings(batch.column(text_at)), batch.column(spans_at).to_pylist()
            new = pa.array([cut(t, s) if s else t for t, s in zip(texts, spans, strict=True)], pa.string())
            columns = [new if i == text_at else c for i, c in enumerate(batch.columns) if i != spans_at]
            yield pa.RecordBatch.from_arrays(columns, names=[n for i, n in enumerate(batch.schema.names) if i != spans_at])

    return run


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind, such as ``[EMAIL]``; a null text becomes empty."""
    key = F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    spans = personal_data(docs).filter("spans <> ''").select(F.col("key").alias("__key"), F.col("spans").alias("__spans")).dropDuplicates(["__key"])
    joined = docs.withColumn("__key", key).join(spans, "__key", "left").drop("__key")
    return joined.mapInArrow(_mask(docs.columns.index("text"), len(docs.columns)), docs.schema)
