"""Near-duplicate detection by SimHash fingerprints and deletion-variant signatures.

A fingerprint has a bit set if that bit is set in over half of the hashes of a
text's word shingles. It is cut into segments. Two fingerprints are compared over
all bits if some segment differs by at most one bit: with one bit of it wiped out
(a deletion variant) it is then equal, so every distinct fingerprint is indexed
under each variant of each segment, and those that share a variant meet in a
bucket. To move less, a row goes out for each quarter of a segment, with that
quarter wiped out, and the variants of the quarter's bits are made where the rows
arrive. Only edges that join what isn't joined yet leave a bucket (at most one less
than its members), so groups of near copies don't become pairs; components are
then found by star contractions.

`near_duplicates` links fingerprints of 64 bits that differ by at most `max_bits`.
With ceil((max_bits + 1) / 2) segments some segment always differs by at most one
bit, so all links are found.

`deduplicated` links texts whose sets of `shingle`-word shingles have a Jaccard
similarity of at least `similarity`. Fingerprints of 64 bits are too coarse for
that (at 0.8 about ten bits differ), so it takes 256 bits in sixteen segments; of the
first 128, up to WIDE_MAX may differ. These links only gather candidates: the shingles of the
texts of a component are then compared exactly, so no pair below the threshold
becomes a link. A pair at the threshold is gathered with a probability of 0.99 and
more (README: measured); copies whose words are equal always.

A bucket of more than `max_bucket` fingerprints is never held in one task, nor a
component with more than `max_shingles` shingles: its members are dealt into parts,
and each pair of parts is compared on its own. Rows of fingerprints that very many
copies share, and fingerprints of very large components, are joined with their
component by a broadcast of bounded size.

A null or empty text has fingerprint zero and links like any other. Repeated rows
have equal fingerprints. Null ids never represent a component unless all its ids
are null. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import HOT_KEYS, join_hot, map_arrow, map_batches, only, staged, texts_of
from lattica.llm.graph import components

SHINGLE, SEED, MAX_BITS, MAX_BUCKET = 4, 42, 4, 16_384
NEAR_SHINGLE, SIMILARITY, WIDE_SEGMENTS, WIDE_MAX, MAX_SHINGLES = 5, 0.8, 16, 32, 1_000_000


def _shingles(text: str, shingle: int) -> tuple[bytes, Iterator[tuple[int, int]], int]:
    """The text's lower-cased words with one space between, where its shingles are in that, and their number."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    return line, zip(starts, ends[min(shingle, len(words)) - 1 :].tolist() or [0]), n


def _majority(hashes: np.ndarray) -> np.ndarray:
    """The bytes of a fingerprint: bits set in over half the rows of bytes."""
    ones = np.zeros(8 * hashes.shape[1], dtype=np.int64)
    for i in range(0, len(hashes), 65_536):
        ones += np.unpackbits(hashes[i : i + 65_536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little")


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a text as a signed 64-bit integer.

    A-Z are lower-cased; words are runs of anything but ASCII white space; a text
    of fewer than `shingle` words is one shingle, one without words gives zero.
    """
    line, places, n = _shingles(text, shingle)
    if not line:
        return 0
    hashed = xxhash.xxh64_intdigest
    h = np.fromiter((hashed(line[a:b], seed) for a, b in places), dtype="<u8", count=n)
    return int(_majority(h.view(np.uint8).reshape(-1, 8)).view("<i8")[0])


def wide_fingerprint(text: str, shingle: int = NEAR_SHINGLE) -> tuple[bytes, list[int], int]:
    """A hash of the text's words, the four parts of its fingerprint of 256 bits over distinct shingles, and their number."""
    line, places, _ = _shingles(text, shingle)
    key = xxhash.xxh3_128_digest(line)
    if not line:
        return key, [0] * 4, 0
    hashed = xxhash.xxh3_128_digest
    distinct = {hashed(line[a:b]) for a, b in places}
    h = np.frombuffer(b"".join(distinct), dtype="<u8").reshape(-1, 2)
    # 128 bits more of each shingle: its hash, scattered by multiplication with odd numbers
    more = (h ^ (h >> np.uint64(32))) * np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
    more = (more ^ (more >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bits = np.concatenate([h, more ^ (more >> np.uint64(32))], axis=1)
    return key, _majority(bits.view(np.uint8)).view("<i8").tolist(), len(distinct)


def shingle_set(text: str, shingle: int = NEAR_SHINGLE) -> np.ndarray:
    """The sorted 64-bit hashes of the distinct shingles of a text."""
    line, places, n = _shingles(text, shingle)
    hashed = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((hashed(line[a:b]) for a, b in places), dtype=np.uint64, count=n)) if line else np.empty(0, np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id_col, text_hash long, fp long) of each row; text_hash tells rows of one id apart."""
    docs = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()

    def hashed(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column("id"), "text_hash": batch.column("text_hash"), "fp": [fingerprint(t, shingle, seed) for t in texts_of(batch)]}

    return map_batches(docs, hashed, f"id {id_type}, text_hash long, fp long").withColumnRenamed("id", id_col)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """Bit ranges [lo, hi) such that of max_bits differing bits some range holds one at most."""
    return cut(64, -(-(max_bits + 1) // 2))


def cut(bits: int, m: int) -> list[tuple[int, int]]:
    """m bit ranges [lo, hi) of about equal width."""
    at = [bits * i // m for i in range(m + 1)]
    return list(zip(at, at[1:]))


QUARTERS = 4


def quarters(ranges: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(lo, hi, from, to): each bit range with each of its quarters."""
    return [(lo, hi, lo + a, lo + b) for lo, hi in ranges for a, b in cut(hi - lo, QUARTERS)]


def variants(members: DataFrame, ranges: list[tuple[int, int]], halves: tuple[str, ...] = ("fp",), carried: tuple[str, ...] = ("fp",)) -> DataFrame:
    """(wild, rest, quarter, then the columns carried): each fingerprint under the segments that have a quarter wiped out.

    halves: its columns of 64 bits, of which no range crosses an end; quarter: the bits wiped out.
    """
    keys = []
    for wild, (lo, hi, a, b) in enumerate(quarters(ranges)):
        part = F.shiftrightunsigned(halves[lo // 64], lo % 64).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        rest = part.bitwiseAND(F.lit((1 << (hi - lo)) - 1 & ~(((1 << (b - a)) - 1) << (a - lo))))
        own = F.shiftrightunsigned(part, a - lo).bitwiseAND(F.lit((1 << (b - a)) - 1))
        keys.append(F.struct(F.lit(wild).cast("byte").alias("wild"), rest.cast("int").alias("rest"), own.cast("byte").alias("quarter")))
    return members.select(*carried, F.explode(F.array(*keys)).alias("key")).select("key.wild", "key.rest", "key.quarter", *carried)


def spanning(members: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among members; each is compared with those not yet reached.

    A row of members is a node, then the halves of its fingerprint; a single column is both.
    """
    u, v = [], []
    rest = members
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            x = frontier.pop()
            near = _distance(rest, x) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                u.append(np.full(len(found), x[0]))
                v.append(found[:, 0])
                frontier.extend(found)
    return (np.concatenate(u), np.concatenate(v)) if u else (members[:0, 0], members[:0, 0])


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of rows of members."""
    first = min(1, a.shape[1] - 1)
    return np.bitwise_count((a[:, first:] ^ b[..., first:]).view(np.uint64)).sum(axis=1)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 16_384) -> Iterator[pa.Table]:
    """The batches, some together, so that what is done for each is worth it."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _linked_in_buckets(key: np.ndarray, members: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the links within each run of equal keys.

    Neighbours at each distance are compared at once; only buckets with several links
    (or of over _WIDE_RUN members) are gone through one by one.
    """
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    bucket, size = np.repeat(np.arange(len(starts)), sizes), np.repeat(sizes, sizes)
    place = np.arange(len(key)) - np.repeat(starts, sizes)
    found, i = [], np.flatnonzero((size > 1) & (size <= _WIDE_RUN))
    links = np.zeros(len(starts), dtype=np.int64)
    for d in range(1, int(sizes[sizes <= _WIDE_RUN].max(initial=1))):
        i = i[(place[i] + d < size[i]) & (links[bucket[i]] < 2)]  # else the pairs of a group of near copies are all held
        if not len(i):
            break
        near = i[_distance(members[i], members[i + d]) <= max_bits]
        np.add.at(links, bucket[near], 1)
        found.append(np.stack([near, near + d]))
    pairs = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
    single = pairs[:, links[bucket[pairs[0]]] == 1]
    u, v = [members[single[0], 0]], [members[single[1], 0]]
    for at in np.flatnonzero((links > 1) | (sizes > _WIDE_RUN)).tolist():
        a, b = spanning(members[starts[at] : starts[at] + sizes[at]], max_bits)
        u.append(a)
        v.append(b)
    return np.concatenate(u), np.concatenate(v)


_WIDE_RUN = 1_024


class Forest:
    """Tells which edges join what earlier ones didn't. Beyond `limit` nodes it starts anew, and some are told again."""

    def __init__(self, limit: int = 200_000) -> None:
        self.root: dict[int, int] = {}
        self.limit = limit

    def joining(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """For each edge, in order, whether it joins two trees."""
        root = self.root
        if len(root) > self.limit:
            root.clear()

        def find(x: int) -> int:
            while (p := root.get(x, x)) != x:
                root[x] = x = root.get(p, p)
            return x

        out = np.zeros(len(u), dtype=bool)
        for i, (a, b) in enumerate(zip(u.tolist(), v.tolist())):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
                out[i] = True
        return out


def _bucket_edges(rows: DataFrame, ranges: list[tuple[int, int]], max_bits: int, max_bucket: int) -> DataFrame:
    """From rows (wild, rest, quarter, members' columns): edges (bit -1), or the buckets (bit, rest, u) of groups of over max_bucket."""
    names = ("bit", "rest", "u", "v")
    columns = rows.columns[2:]  # the quarter, then the member
    lo, _, first, last = (np.array(x, dtype=np.int64) for x in zip(*quarters(ranges)))
    width = int((last - first).max())

    def out(bit: np.ndarray, rest: np.ndarray, u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(bit, pa.int16()), pa.array(rest, pa.int64()), pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=names)

    def fine(key: np.ndarray, members: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each bit of the quarters: it, and of the rows that have it their place, bit and segment without it."""
        wild, value = key >> 56, members[:, 0]
        for j in range(width):
            has = np.flatnonzero(first[wild] + j < last[wild])
            rest = (key[has] & ((1 << 56) - 1)) | ((value[has] & ~(1 << j)) << (first - lo)[wild[has]])
            yield j, has, (first[wild] + j)[has], rest

    def edges(key: np.ndarray, members: np.ndarray, forest: Forest) -> pa.RecordBatch:
        at = np.cumsum(np.r_[0, key[1:] != key[:-1]])
        parts = [(at[has] * width + j, bit, rest, has) for j, has, bit, rest in fine(key, members)]
        group, bit, rest, has = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((rest, group))
        group, rest, has = group[order], rest[order], has[order]
        u, v = _linked_in_buckets(np.cumsum(np.r_[0, (group[1:] != group[:-1]) | (rest[1:] != rest[:-1])]), members[has, 1:], max_bits)
        # near copies meet in very many buckets of a task: each is joined once
        new = forest.joining(u, v)
        u, v = u[new], v[new]
        none = np.full(len(u), -1)
        return out(none, none, u, v)

    def large(key: int, members: np.ndarray) -> Iterator[pa.RecordBatch]:
        for _, has, bit, rest in fine(np.full(len(members), key), members):
            yield out(bit, rest, members[has, 1], members[has, 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, over, forest = np.empty(0, np.int64), np.empty((0, len(columns)), np.int64), None, Forest()
        for b in _gathered(batches):
            key = np.r_[held_key, (b.column("wild").to_numpy().astype(np.int64) << 56) | b.column("rest").to_numpy()]
            members = np.concatenate([held, np.stack([b.column(c).to_numpy() for c in columns], axis=1)])
            if not len(key):
                continue
            end = int(np.searchsorted(key, key[-1], side="left"))
            if over is not None and end:  # the large group ends within these rows
                done = int(np.searchsorted(key, over, side="right"))
                if done:
                    yield from large(over, members[:done])
                key, members, end, over = key[done:], members[done:], end - done, None
            if end > 0:
                yield edges(key[:end], members[:end], forest)
            held_key, held = key[max(end, 0) :], members[max(end, 0) :]
            if len(held_key) and (over is not None or len(held_key) > max_bucket):
                over = int(held_key[0])
                yield from large(over, held)
                held_key, held = held_key[:0], held[:0]
        if len(held_key):
            if over is not None and int(held_key[0]) == over:
                yield from large(over, held)
            else:
                yield edges(held_key, held, forest)

    return rows.repartition("wild", "rest").sortWithinPartitions("wild", "rest").mapInArrow(run, "bit short, rest long, u long, v long")


def _large_bucket_edges(rows: DataFrame, max_bits: int, max_bucket: int) -> DataFrame:
    """Edges of the buckets in rows (bit, rest, members' columns), each pair of parts of at most about max_bucket / 2 members by itself."""
    import pandas as pd

    columns = rows.columns[2:]
    parts = rows.groupBy("bit", "rest").agg(F.ceil(2 * F.count(F.lit(1)) / max_bucket).cast("int").alias("parts"))
    dealt = rows.join(parts, ["bit", "rest"]).withColumn("own", F.pmod(F.xxhash64(columns[0]), F.col("parts")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("bit", "rest", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *columns)

    def linked(group: pd.DataFrame) -> pd.DataFrame:
        u, v = spanning(group[columns].to_numpy(), max_bits)
        return pd.DataFrame({"u": u, "v": v})

    return paired.groupBy("bit", "rest", "i", "j").applyInPandas(linked, "u long, v long")


def _links(members: DataFrame, ranges: list[tuple[int, int]], halves: tuple[str, ...], carried: tuple[str, ...], max_bits: int, max_bucket: int) -> DataFrame:
    """(u, v): edges that span the members who meet in a bucket and differ by max_bits at most.

    halves: the columns of a member's fingerprint; carried: its node, then those of the
    halves that are compared; a single column is both.
    """
    found = staged(_bucket_edges(variants(members, ranges, halves, carried), ranges, max_bits, max_bucket), "buckets")
    over = found.where(F.col("rest") >= 0).select("bit", "rest", F.col("u").alias(carried[0]))
    if len(carried) > 1:
        over = over.join(members.select(*carried), carried[0]).select("bit", "rest", *carried)
    return found.where(F.col("rest") < 0).select("u", "v").unionByName(_large_bucket_edges(over, max_bits, max_bucket))


def links(fps: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(u, v): edges among the distinct fingerprints `fps` whose components are those of all links."""
    return _links(fps, segments(max_bits), ("fp",), ("fp",), max_bits, max_bucket)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET, hot_keys: int = HOT_KEYS) -> DataFrame:
    """(id_col, text_hash, fp, component_id) of each row: the smallest id that it reaches over links."""
    own = staged(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    distinct = staged(own.groupBy("fp").agg(F.min(id_col).alias("least"), F.count(F.lit(1)).alias("n")), "distinct")
    roots = components(links(distinct.select("fp"), max_bits, max_bucket)).withColumnRenamed("node", "fp")
    grouped = staged(roots.join(distinct, "fp").select("fp", "root", "least"), "grouped")
    by_root = staged(grouped.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size")), "by-root")
    classes = join_hot(grouped, by_root, "root", "size", hot_keys).select("fp", "component_id")
    known = staged(distinct.join(classes, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"), "n"), "classes")
    return join_hot(own, known, "fp", "n", hot_keys).select(id_col, "text_hash", "fp", "component_id")


def similar(sets: list[np.ndarray], similarity: float = SIMILARITY, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the ends of edges that span all pairs of sets with that Jaccard similarity.

    From a set, those not reached yet are found by the postings of its own elements.
    With a side (0 or 1) for each set, only edges between sides that join what the
    links within either side don't: those are found elsewhere.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(code, kind="stable")
    posted, first = owner[order], np.r_[0, np.cumsum(np.bincount(code))]
    codes = np.split(code, np.cumsum(sizes)[:-1])

    def near(x: int, among: np.ndarray) -> np.ndarray:
        owners = np.concatenate([posted[first[c] : first[c + 1]] for c in codes[x].tolist()] or [posted[:0]])
        both = np.bincount(owners, minlength=len(sets))
        return np.flatnonzero(among & (both > 0) & (both >= similarity * (sizes[x] + sizes - both) - 1e-9))

    def spanned(left: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        u, v, group = [], [], np.arange(len(sets))
        for root in np.flatnonzero(left).tolist():
            frontier = [root] if left[root] else []
            left[root] = False
            while frontier and left.any():
                x = frontier.pop()
                found = near(x, left)
                left[found] = False
                group[found] = root
                u.append(np.full(len(found), x))
                v.append(found)
                frontier.extend(found.tolist())
        return u, v, group

    none = np.empty(0, np.int64)
    if side is None:
        u, v, _ = spanned(np.ones(len(sets), dtype=bool))
        return np.concatenate([none, *u]), np.concatenate([none, *v])
    group = np.where(side == 0, spanned(side == 0)[2], spanned(side == 1)[2])
    other, u, v = side == 1, [], []
    for x in np.flatnonzero(side == 0).tolist():
        apart = other & (group != group[x])
        if not apart.any():
            continue
        for y in near(x, apart).tolist():
            if group[y] != group[x]:
                u.append(x)
                v.append(y)
                group[group == group[y]] = group[x]
    return np.array(u, dtype=np.int64), np.array(v, dtype=np.int64)


def _pair_similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def verified(members: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(u, v): edges of the pairs of nodes of one group that are similar, from rows (root, i, j, own, node, shingles), own being a node's part i or j, of groups that fit a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, np.ndarray]] = []
        at: tuple[int, int, int] | None = None
        us: list[int] = []
        vs: list[int] = []

        def done() -> None:
            if len(held) > 1:
                nodes, sets = [n for n, _, _ in held], [s for _, _, s in held]
                if len(held) == 2:
                    u, v = ([0], [1]) if _pair_similar(*sets, similarity) else ([], [])
                else:
                    u, v = similar(sets, similarity, np.array([int(own != at[1]) for _, own, _ in held]) if at[1] != at[2] else None)
                us.extend(nodes[k] for k in u)
                vs.extend(nodes[k] for k in v)
            held.clear()

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("root", "i", "j")))
            for key, node, own, s in zip(keys, batch.column("node").to_pylist(), batch.column("own").to_pylist(), batch.column("shingles")):
                if key != at:
                    done()
                    at = key
                held.append((node, own, np.frombuffer(s.as_buffer(), dtype=np.uint64).copy()))
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
            us.clear()
            vs.clear()
        done()
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return map_arrow(members.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j"), run, "u long, v long")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = NEAR_SHINGLE, similarity: float = SIMILARITY, max_bits: int = WIDE_MAX, max_bucket: int = MAX_BUCKET, max_shingles: int = MAX_SHINGLES, hot_keys: int = HOT_KEYS) -> DataFrame:
    """The rows of docs, one for each group of near copies: that with the smallest id, then the first in the table.

    Rows are told apart by their place, not by their id: two groups that hold one id
    leave a row each. A row with a null id stays only where no row of its group has
    an id. All columns stay as they are, whatever their names.
    """
    names = docs.columns
    # rows are written once with their number; afterwards only numbers, keys and fingerprints move, and the shingles of candidates
    rows = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{n}`") for n in names]).alias("own")), "rows")
    id_type, halves = docs.schema[id_col].dataType.simpleString(), ("h0", "h1", "h2", "h3")

    def measured(batch: pa.RecordBatch) -> dict:
        found = [wide_fingerprint(t, shingle) for t in texts_of(batch)]
        parts = {h: [f[1][i] for f in found] for i, h in enumerate(halves)}
        return {"row": batch.column("row"), "id": batch.column("id"), "words": [f[0] for f in found], **parts, "n": [f[2] for f in found]}

    texts = rows.select("row", F.col("own")[id_col].alias("id"), F.col("own")[text_col].alias("text"))
    prints = map_batches(texts, measured, f"row long, id {id_type}, words binary, {', '.join(f'{h} long' for h in halves)}, n long")
    best = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row"))
    nodes = staged(prints.groupBy("words").agg(F.min(best).alias("best"), *[F.first(h).alias(h) for h in (*halves, "n")]).select(F.col("best.row").alias("node"), "best", *halves, "n"), "nodes")
    gathered = components(_links(nodes.where("n > 0").select("node", *halves), cut(256, WIDE_SEGMENTS), halves, ("node", *halves[:2]), max_bits, max_bucket))
    grouped = staged(gathered.join(nodes, "node").select("root", "node", "n"), "candidates")
    parts = staged(grouped.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.ceil(2 * F.sum("n") / max_shingles).cast("int").alias("parts")), "parts")
    dealt = join_hot(grouped, parts, "root", "size", hot_keys).withColumn("own", F.when(F.col("parts") > 2, F.pmod(F.xxhash64("node"), F.col("parts"))).otherwise(0).cast("int"))

    def shingled(batch: pa.RecordBatch) -> dict:
        return {c: batch.column(c) for c in ("root", "node", "parts", "own")} | {"shingles": [shingle_set(t, shingle).tobytes() for t in texts_of(batch)]}

    chosen = only(texts, staged(dealt.select(F.col("node").alias("row"), "root", "parts", "own"), "dealt"), "row").withColumnRenamed("row", "node")
    sets = map_batches(chosen.select("root", "node", "parts", "own", "text"), shingled, "root long, node long, parts int, own int, shingles binary")
    other = F.explode(F.when(F.col("parts") > 2, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.lit(0))))
    pairs = sets.withColumn("other", other).select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "shingles")
    # written before the contraction: else each task holds a second Python worker beside the sets
    similar_pairs = staged(verified(pairs, similarity), "similar")
    roots = staged(components(similar_pairs).join(nodes, "node").select("root", "node", "best"), "groups")
    winners = staged(roots.groupBy("root").agg(F.min("best").alias("first"), F.count(F.lit(1)).alias("size")), "winners")
    losers = join_hot(roots, winners, "root", "size", hot_keys).where("best.row <> first.row").select("node")
    kept = nodes.select(F.col("node").alias("row")).join(losers, F.col("row") == F.col("node"), "left_anti")
    return only(rows, staged(kept, "kept"), "row").select(*[F.col("own")[n].alias(n) for n in names])
