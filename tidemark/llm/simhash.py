"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits over 4-word shingles. Fingerprints that differ in at most four bits are linked, and linked
documents form a component. Three segments cut the fingerprint: of four differing bits, one segment holds at most one.
So each fingerprint is entered in a table under its three segment values, the Hamming ball of radius one around each
segment is looked up there, and every candidate is compared in all 64 bits. A ball reaches its neighbours from either
side, so only the half that sets at least as many bits as it clears is enumerated.

Scale: texts are read once and never shuffled; what moves are distinct fingerprints, about 37 keys each. Copies share
one fingerprint. A segment value with many fingerprints makes a hot join key, which adaptive execution splits; matches
stream through a spanning forest inside the task that finds them, so a dense group leaves as many edges as it has
members and not as pairs. Chance candidates grow with the square of the number of distinct fingerprints, divided by two to
the width of a segment. For collections of billions ``segments=2`` looks up balls of radius two in tables of 32 bits,
about 790 keys each: more keys, but 2,048 times fewer chance candidates for each of them. The links are the same.

Edge cases: a null or empty text has no shingle and fingerprint zero, which links like any other. Null ids are kept and
never name a component unless no other id is in it. Repeated rows stay. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, chunks, plain, xxh64
from tidemark.session import materialise

SHINGLE = 4
MAX_BITS = 4
SEED = 42
FOREST_NODES = 500_000

_LOW = np.uint64(0x0101010101010101)
SLICE = 1 << 18


def _lane(h: np.ndarray, lane: int) -> np.ndarray:
    """The hash itself, then further hashes made of it."""
    if not lane:
        return h
    h = (h + np.uint64(lane)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _fingerprints(texts: list[bytes], size: int, lanes: int = 1) -> np.ndarray:
    """Fingerprints as signed 64-bit values, ``lanes`` of them for each text."""
    w = Words(texts)
    counts = np.where(w.counts >= size, w.counts - size + 1, (w.counts > 0).astype(np.int64))
    first = np.repeat(w.first[:-1], counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = first + offset
    last = begin + np.minimum(np.repeat(w.counts, counts), size) - 1
    owner = np.repeat(np.arange(len(texts)), counts)
    # columns: bit k of each of the eight bytes, summed as eight byte-wide lanes over at most 255 shingles
    ones = np.zeros((len(texts), lanes * 64), np.int64)
    for lo in range(0, len(begin), SLICE):
        part = slice(lo, lo + SLICE)
        shingles = xxh64(w.buf, w.start[begin[part]], w.end[last[part]], SEED)
        own = owner[part]
        within = np.arange(len(own)) - np.searchsorted(own, own)
        cuts = np.flatnonzero(within % 255 == 0)
        for lane in range(lanes):
            h = _lane(shingles, lane)
            for bit in range(8):
                sums = np.add.reduceat((h >> np.uint64(bit)) & _LOW, cuts)
                for byte in range(8):
                    got = ((sums >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)
                    np.add.at(ones[:, 64 * lane + 8 * byte + bit], own[cuts], got)
    set_bits = (2 * ones > counts[:, None]).astype(np.uint64).reshape(len(texts), lanes, 64)
    found = (set_bits << np.arange(64, dtype=np.uint64)).sum(axis=2, dtype=np.uint64).view(np.int64)
    return found[:, 0] if lanes == 1 else found


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """SimHash of a text column as a signed long."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        found = [_fingerprints(part, shingle) for part in chunks(texts, plain)]
        return pd.Series(np.concatenate(found) if found else np.empty(0, np.int64))

    return simhash(text)


def _segments(count: int) -> list[tuple[int, int]]:
    """Shift and width of each segment."""
    cuts = [64 * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _value(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def _ball(value: Column, segment: int, width: int, radius: int) -> Column:
    """Keys of the values in up to ``radius`` (one or two) flipped bits that set no fewer bits than they clear."""
    flips = [1 << i for i in range(width)]
    if radius == 2:
        flips += [(1 << i) | (1 << j) for i in range(width) for j in range(i)]
    masks = F.array(F.lit(0).cast("long"), *[F.lit(m).cast("long") for m in flips])
    half = F.filter(masks, lambda m: 2 * F.bit_count(value.bitwiseAND(m)) <= F.bit_count(m))
    return F.transform(half, lambda m: F.struct(F.lit(segment).alias("seg"), value.bitwiseXOR(m).alias("val")))


def forest(edges: DataFrame) -> DataFrame:
    """Edges ``a``, ``b`` reduced to a spanning forest within each task; connectivity is kept, memory is bounded."""

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict[int, int] = {}

        def root(x):
            parent.setdefault(x, x)
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def flush():
            kept = [(x, r) for x in parent if (r := root(x)) != x]
            parent.clear()
            return pd.DataFrame(kept, columns=["a", "b"]).astype("int64")

        for batch in batches:
            for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
                ra, rb = root(a), root(b)
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
            if len(parent) > FOREST_NODES:
                yield flush()
        yield flush()

    return edges.select("a", "b").mapInPandas(reduce, "a long, b long")


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, segments: int = 3) -> DataFrame:
    """Edges ``a``, ``b`` that connect distinct fingerprints (column ``fp``) at most ``max_bits`` apart.

    The edges of a task form a forest: components are whole, single pairs inside a component may be left out.
    """
    radius = max(max_bits // segments, 1)
    if radius > 2:
        raise ValueError("at most two bits may differ in a segment: use more segments")
    parts = _segments(segments)
    fp = F.col("fp")
    keyed = [F.struct(F.lit(k).alias("seg"), _value(fp, s, w).alias("val"), F.lit(False).alias("probe"))
             for k, (s, w) in enumerate(parts)]
    table = fingerprints.select(fp.alias("b"), F.explode(F.array(*keyed)).alias("k")).select(
        "b", F.col("k.seg").alias("seg"), F.col("k.val").alias("val")
    )
    balls = [_ball(_value(fp, s, w), k, w, radius) for k, (s, w) in enumerate(parts)]
    probes = fingerprints.select(fp.alias("a"), F.explode(F.concat(*balls)).alias("k")).select(
        "a", F.col("k.seg").alias("seg"), F.col("k.val").alias("val")
    )
    a, b = F.col("a"), F.col("b")
    # an equal segment is met from both sides: keep one
    exact = F.lit(False)
    for k, (s, w) in enumerate(parts):
        exact = exact | ((F.col("seg") == k) & (_value(a, s, w) == _value(b, s, w)))
    near = (F.bit_count(a.bitwiseXOR(b)) <= max_bits) & (a != b) & (~exact | (a < b))
    return forest(probes.join(table, ["seg", "val"]).filter(near))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its smallest reachable node) for every node of ``edges``; roots name themselves.

    Large-star and small-star steps in turn, each written to the shared folder; hub nodes are joined, not gathered.
    """
    now = materialise(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )

    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = state(now)
    while before[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                             F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                                            .alias("e")).select("e.a", "e.b")
        now = materialise(small.filter("a <> b").distinct(), "edges")
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def with_component(marked: DataFrame, max_bits: int = MAX_BITS, segments: int = 3) -> DataFrame:
    """Adds ``component``, the smallest linked fingerprint, to rows with ``fp``."""
    prints = materialise(marked.select("fp").distinct(), "prints")
    roots = materialise(components(links(prints, max_bits, segments)).withColumnRenamed("node", "fp"), "roots")
    return marked.join(roots, "fp", "left").withColumn("component", F.coalesce("root", "fp")).drop("root")


def near_duplicates(documents: DataFrame, max_bits: int = MAX_BITS, segments: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` (long), ``fingerprint`` (hex) and ``component_id`` of every document."""
    marked = materialise(documents.select("doc_id", fingerprint(F.col("text")).alias("fp")), "fingerprints")
    least = with_component(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), max_bits, segments)
    least = materialise(least, "least")
    named = least.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = materialise(least.join(named, "component").select("fp", "component_id"), "print_components")
    return marked.join(of_print, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(documents: DataFrame, max_bits: int = MAX_BITS, segments: int = 3) -> DataFrame:
    """The documents without near-duplicates: of each component the one with the smallest id stays.

    Rows that tie in the id are told apart by their text; of rows equal in both, one stays. All columns are kept.
    """
    # two 64-bit keys name a row and are never null
    id_key, text_key = F.xxhash64(F.lit("id"), "doc_id"), F.xxhash64(F.lit("text"), "text")
    marked = materialise(
        documents.select("doc_id", id_key.alias("k1"), text_key.alias("k2"), fingerprint(F.col("text")).alias("fp")),
        "fingerprints",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "k2", "k1")).alias("best")
    best = with_component(marked, max_bits, segments).groupBy("component").agg(first)
    kept = materialise(best.select(F.col("best.k1").alias("k1"), F.col("best.k2").alias("k2")), "kept")
    return _with_keys(documents, id_key, text_key).join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select("row.*")


def _with_keys(documents: DataFrame, id_key: Column, text_key: Column) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    return documents.select(row, id_key.alias("k1"), text_key.alias("k2"))


# -- fingerprints of three lanes, for similarities from about 0.8

LANES = 3
WIDE_SHINGLE = 5
WIDE_SEGMENTS = 4  # of each lane
WIDE_BITS = 34


def wide_fingerprint(text: Column, shingle: int = WIDE_SHINGLE) -> Column:
    """SimHash of ``LANES`` times 64 bits."""

    @F.pandas_udf("array<long>")
    def simhash(texts: pd.Series) -> pd.Series:
        found = [_fingerprints(part, shingle, LANES) for part in chunks(texts, plain)]
        return pd.Series(list(np.concatenate(found)) if found else [], dtype=object)

    return simhash(text)


def _wide_sides(prints: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """Bucket entries (``b``), probes (``a``) and whether two that meet in a bucket are not met again from the other side."""
    parts = [(lane, shift, width) for lane in range(LANES) for shift, width in _segments(WIDE_SEGMENTS)]

    def side(name, keys):
        lanes = [F.col("lanes")[i].alias(f"{name}{i}") for i in range(LANES)]
        return prints.select(F.col("node").alias(name), F.col("part").alias(f"{name}_part"), *lanes, F.inline(keys))

    values = [_value(F.col("lanes")[lane], shift, width) for lane, shift, width in parts]
    own = [F.struct(F.lit(k).alias("seg"), v.alias("val")) for k, v in enumerate(values)]
    balls = [_ball(v, k, parts[k][2], 1) for k, v in enumerate(values)]
    exact = F.lit(False)
    for k, (lane, shift, width) in enumerate(parts):
        same = _value(F.col(f"a{lane}"), shift, width) == _value(F.col(f"b{lane}"), shift, width)
        exact = exact | ((F.col("seg") == k) & same)
    return side("b", F.array(*own)), side("a", F.concat(*balls)), ~exact | (F.col("a") < F.col("b"))


def wide_parts(prints: DataFrame, max_bits: int = WIDE_BITS) -> DataFrame:
    """``node``, ``lanes`` and ``part``, the smallest node it is linked with, of fingerprints at most ``max_bits`` apart.

    Twelve segments of 16 bits with balls of radius one. Of fingerprints that differ in 15 % of their bits (a shingle
    similarity of 0.8) a segment holds at most one difference with probability 0.28, one of twelve with 0.98; the more alike
    two texts are the surer they meet. What meets is compared in all bits. A bucket may hold thousands of near copies, so
    its entries are first compared with the bucket's smallest one alone, which ties a dense group together with as many
    edges as it has members; then all that meet are compared, of which only what is still apart gives edges.
    """
    apart = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(LANES)), F.lit(0))
    near = (apart <= max_bits) & (F.col("a") != F.col("b"))

    def united(parts: DataFrame, edges: DataFrame) -> DataFrame:
        roots = materialise(components(forest(edges)).withColumnRenamed("node", "part"), "roots")
        joined = parts.join(roots, "part", "left").select("node", "lanes", F.coalesce("root", "part").alias("part"))
        return materialise(joined, "parts")

    parts = prints.select("node", "lanes", F.col("node").alias("part"))
    table, probes, _ = _wide_sides(parts)
    first = table.groupBy("seg", "val").agg(F.min(F.struct("b", *[f"b{i}" for i in range(LANES)])).alias("e"))
    parts = united(parts, probes.join(first.select("seg", "val", "e.*"), ["seg", "val"]).filter(near).select("a", "b"))
    table, probes, once = _wide_sides(parts)
    split = F.col("a_part") != F.col("b_part")
    met = probes.join(table, ["seg", "val"]).filter(near & once & split)
    return united(parts, met.select(F.col("a_part").alias("a"), F.col("b_part").alias("b")))


def keep_one_similar(documents: DataFrame, max_bits: int = WIDE_BITS) -> DataFrame:
    """As ``keep_one`` for texts alike in about 0.8 of their five-word shingles.

    A 64-bit fingerprint puts such pairs ten bits apart, give or take three, which neither parts them well from others nor
    leaves a segment alike. Three lanes keep the spread small against the distance. A fingerprint is known by a 64-bit hash
    of its lanes.
    """
    id_key, text_key = F.xxhash64(F.lit("id"), "doc_id"), F.xxhash64(F.lit("text"), "text")
    marked = documents.select("doc_id", id_key.alias("k1"), text_key.alias("k2"), wide_fingerprint(F.col("text")).alias("lanes"))
    marked = materialise(marked.withColumn("node", F.xxhash64("lanes")), "fingerprints")
    prints = materialise(marked.groupBy("node").agg(F.first("lanes").alias("lanes")), "prints")
    parts = wide_parts(prints, max_bits).select("node", F.col("part").alias("component"))
    grouped = marked.drop("lanes").join(parts, "node")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "k2", "k1")).alias("best")
    best = grouped.groupBy("component").agg(first)
    kept = materialise(best.select(F.col("best.k1").alias("k1"), F.col("best.k2").alias("k2")), "kept")
    return _with_keys(documents, id_key, text_key).join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select("row.*")
