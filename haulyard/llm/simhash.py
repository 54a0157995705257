"""Near-duplicates by fingerprints: a SimHash per text, all fingerprints within a radius linked exactly.

The fingerprint: words of the lower-cased (A-Z) text, shingles of ``size`` consecutive words, XXH64
(seed 42) of each shingle, a bit set when it is set in more than half of the hashes.

Distinct fingerprints are compared exactly, in tiles. Two fingerprints within ``radius`` bits agree in
at least one of radius + 1 bands of bits, so each band's groups of equal band value are the blocks of a
comparison. A block is cut into tiles in the order of population counts, at most ``tile`` rows each;
tiles whose population counts differ by more than the radius are never paired. A pair of tiles is
compared in one task with numpy (exclusive or, bit counts) and yields only the links that join what is
not yet joined, so a block of near copies gives as many rows as it has members, not their square.

Defined cases: a null or empty text, or one of blanks, has the fingerprint zero, which is linked like
any other; a text with fewer words than a shingle is one shingle. Equal fingerprints are one class.
Rows without a doc_id take part; a class without any doc_id has a null component_id. Result columns
replace input columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from haulyard.llm.components import components
from haulyard.llm.frames import add_columns, col
from haulyard.session import materialise

SIZE = 4
RADIUS = 4
SEED = 42
BITS = 64
TILE = 8192
PIECE = 255  # ones that a byte can count
LUMP = 16  # small blocks compared by one call
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(data: bytes | None, size: int = SIZE) -> list[int]:
    own = data.lower().split() if data else []  # bytes: A-Z and the six ASCII blanks only
    if not own:
        return []
    joined = b" ".join(own)
    if len(own) <= size:
        return [xxh64_intdigest(joined, SEED)]
    ends = (np.cumsum([len(w) + 1 for w in own]) - 1).tolist()
    starts = [0, *[e + 1 for e in ends]]
    return [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :])]


def majorities(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per run of ``lengths`` hashes the 64 bits that are set in more than half of them; 0 for an empty run."""
    out = np.zeros(len(lengths), np.uint64)
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    starts = (np.cumsum(lengths) - lengths)[full]
    lengths = lengths[full]
    # eight byte counters lie in one number, so runs are cut into pieces of at most 255
    pieces = -(-lengths // PIECE)
    first = np.cumsum(pieces) - pieces
    within = np.arange(pieces.sum()) - np.repeat(first, pieces)
    cuts = np.repeat(starts, pieces) + within * PIECE
    bits = np.zeros(len(full), np.uint64)
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & LANES, cuts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for byte in range(8):
            most = (2 * counts[:, byte] > lengths).astype(np.uint64)
            bits |= most << np.uint64(8 * byte + shift)
    out[full] = bits
    return out


def fingerprints(texts: list[bytes | None], size: int = SIZE) -> np.ndarray:
    hashes = [np.array(shingle_hashes(t, size), np.uint64) for t in texts]
    return majorities(np.concatenate(hashes), np.array([len(h) for h in hashes]))


def with_fingerprint(docs: DataFrame, text: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit number."""

    def compute(texts, _):
        return {"fingerprint": fingerprints(texts, size).view(np.int64)}

    return add_columns(docs, text, "fingerprint long", compute)


def joining_links(left: np.ndarray, right: np.ndarray | None, radius: int, rows: int = 128) -> list[tuple[int, int]]:
    """Links within ``radius`` bits that connect all that is connected: inside ``left``, or between both.

    Positions in ``right`` count on from those in ``left``. A few rows are compared with all columns at
    a time; of the finds only those between different sets are looked at further.
    """
    inside = right is None
    other = left if inside else right
    shift = 0 if inside else len(left)
    root = np.arange(len(left) + (0 if inside else len(right)))
    links: list[tuple[int, int]] = []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = int(root[x])
        return x

    for at in range(0, len(left), rows):
        first = at + 1 if inside else 0
        near = np.bitwise_count(left[at : at + rows, None] ^ other[None, first:]) <= radius
        i, j = np.nonzero(near)
        i, j = i + at, j + first + shift
        if inside:
            i, j = i[i < j], j[i < j]
        apart = root[i] != root[j]
        if not apart.any():
            continue
        i, j = i[apart], j[apart]
        # one find per pair of sets is enough
        _, once = np.unique(root[i] * np.int64(len(root)) + root[j], return_index=True)
        for x, y in zip(i[once].tolist(), j[once].tolist()):
            a, b = top(x), top(y)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((x, y))
        while (root[root] != root).any():
            root = root[root]
    return links


def _bands(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 1 bands that cover the 64 bits."""
    edges = [round(k * BITS / (radius + 1)) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fingerprint``) that connect all within ``radius``."""
    blocks = [
        F.struct(F.lit(k).cast("byte").alias("band"), (F.shiftrightunsigned("fingerprint", s).bitwiseAND(F.lit((1 << w) - 1))).cast("int").alias("value"))
        for k, (s, w) in enumerate(_bands(radius))
    ]
    rows = prints.select("fingerprint", F.bit_count("fingerprint").cast("int").alias("ones"), F.explode(F.array(*blocks)).alias("block")).select("fingerprint", "ones", "block.*")
    block = ["band", "value"]
    # per block and population count: where its rows begin in the order of population counts
    counts = rows.groupBy(*block, "ones").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*block).orderBy("ones")
    sizes = counts.select(
        *block, "ones", "n",
        F.sum("n").over(Window.partitionBy(*block)).alias("total"),
        (F.sum("n").over(order) - F.col("n")).alias("before"),
    ).where(F.col("total") > tile)
    sizes = materialise(sizes)
    # only blocks beyond one tile are cut; a population count with more rows than a tile takes several
    cut = sizes.select(
        *block, "ones",
        F.when(F.col("n") <= tile, F.floor(F.col("before") / tile)).otherwise(F.floor(F.col("before") / tile) + 1).alias("first"),
        F.ceil(F.col("n") / tile).cast("int").alias("pieces"),
    )
    sub = F.pmod(F.xxhash64("fingerprint"), F.col("pieces")).cast("int")
    large = rows.join(cut, [*block, "ones"]).withColumn("tile", F.concat_ws("-", F.when(F.col("pieces") > 1, F.col("ones")).otherwise(F.lit(-1)), "first", F.when(F.col("pieces") > 1, sub).otherwise(F.lit(0))))
    small = rows.join(sizes.select(*block).distinct(), block, "left_anti").withColumn("tile", F.lit("all"))
    tiles = large.groupBy(*block, "tile").agg(F.min("ones").alias("low"), F.max("ones").alias("high"))
    tiles = materialise(tiles)
    x, y = tiles.alias("x"), tiles.alias("y")
    pairs = x.join(y, block).where(
        (F.col("x.tile") <= F.col("y.tile")) & (F.col("y.low") - F.col("x.high") <= radius) & (F.col("x.low") - F.col("y.high") <= radius)
    ).select(*block, F.concat_ws(":", "x.tile", "y.tile").alias("pair"), F.col("x.tile").alias("one"), F.col("y.tile").alias("two"))
    sides = pairs.select(*block, "pair", F.col("one").alias("tile"), F.lit(0).alias("side")).union(
        pairs.where("one != two").select(*block, "pair", F.col("two").alias("tile"), F.lit(1).alias("side"))
    )
    work = small.select("fingerprint", *block, F.col("tile").alias("pair"), F.lit(0).alias("side"), F.floor(F.col("value") / LUMP).cast("int").alias("lump")).union(
        large.join(sides, [*block, "tile"]).select("fingerprint", *block, "pair", "side", "value")
    )

    def compare(group: pa.Table) -> pa.Table:
        prints, side, value = (group.column(n).to_numpy() for n in ("fingerprint", "side", "value"))
        order = np.lexsort((prints, side, value))
        prints, side, value = prints[order], side[order], value[order]
        out = [prints[:0].reshape(0, 2)]
        starts = [0, *(np.flatnonzero(np.diff(value)) + 1).tolist(), len(value)]
        for a, b in zip(starts, starts[1:]):
            if b - a > 1:
                n = int((side[a:b] == 0).sum())
                own = prints[a:b].view(np.uint64)
                found = joining_links(own[:n], own[n:] if n < b - a else None, radius)
                if found:
                    out.append(prints[a:b][np.array(found)])
        links = np.concatenate(out)
        return pa.table({"a": links[:, 0], "b": links[:, 1]})

    return work.groupBy("band", "lump", "pair").applyInArrow(compare, "a long, b long")


def class_of(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(fingerprint, least, root) of the distinct fingerprints of ``prints``: least key, and the least fingerprint that links reach."""
    one = materialise(prints.groupBy("fingerprint").agg(F.min("_key").alias("least")))
    nets = components(links(one.select("fingerprint"), radius, tile))
    return materialise(one.join(nets, one.fingerprint == nets.node, "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(key, fingerprint, component_id) for every row of ``docs``; the component is its least key."""
    prints = materialise(with_fingerprint(docs.select(col(key).alias("_key"), col(text).alias("_text")), "_text", size).drop("_text"))
    netted = class_of(prints, radius, tile)
    heads = netted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = netted.join(heads, "root").select(F.col("fingerprint").alias("_print"), "component_id")
    out = prints.join(named, prints.fingerprint == named["_print"])
    return out.select(F.col("_key").alias(key), "fingerprint", "component_id")


def hexadecimal(name: str = "fingerprint"):
    """The signed number as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row of each component: one with the least key, null keys last.

    Rows are told apart by a number stored beside their fingerprint, not by their key: rows that share a key but not a
    text are judged apart, and of exact copies under one key, or without keys, one row stays.
    """
    rest = [c for c in docs.columns if c != text]
    packed = docs.select(F.struct(*[col(c) for c in rest]).alias("_rest"), col(key).alias("_key"), col(text).alias("_text"))
    stored = materialise(with_fingerprint(packed, "_text", size).withColumn("_row", F.monotonically_increasing_id()))
    prints = stored.select("_key", "_row", "fingerprint")
    named = class_of(prints, radius, tile).select("fingerprint", "root")
    # equal fingerprints become one row each before they meet their root, so a large group of copies stays small
    rank = F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("key"), F.col("_row").alias("row"))
    first = prints.groupBy("fingerprint").agg(F.min(rank).alias("first")).join(named, "fingerprint")
    stay = first.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("_row"))
    own = [F.col("_text").alias(c) if c == text else F.col("_rest")[c].alias(c) for c in docs.columns]
    return stored.join(stay, "_row", "left_semi").select(*own)
