"""Exact removal of long repeated byte strings, by suffix arrays over what may repeat.

Every byte covered by a ``WIDTH``-byte string that also starts elsewhere in
the corpus is removed; matches stay within a document, overlaps count.

A suffix array over the whole corpus would pass every byte through sorts many
times over, so Spark first narrows it down, losing nothing. Each window of
``WIDTH`` bytes has an anchor: the leftmost of its ``GRAM``-byte grams with the
least hash. Equal windows have equal anchors at equal places, so only windows
of anchors that occur twice can repeat. An anchor's region is all the windows
that have it; regions that are equal as a whole repeat as a whole, whatever
their number, and need no sorting. What is left are the anchors with several
different regions, where repeats begin and end. Their regions are dealt by
anchor to tasks, each of which builds an enhanced suffix array (suffix order,
longest common prefixes) over its regions, scans it with a stack for the
intervals of suffixes with a common prefix of ``WIDTH`` or more (the interval
tree), and keeps those whose occurrences differ in the byte to their left, or
begin their region: the maximal repeats, each with all its occurrences. Every
repeated window lies in one of these.

An anchor with more than ``SPLIT_OVER`` regions (a passage in very many
contexts) doesn't go to one task: the first ``WIDTH`` bytes of its suffixes are
grouped by hash over all tasks, combined before the shuffle, which gives the
same windows.

Rows are told apart by a 64-bit key of id and text. A span is applied only
where the text there has the region's hash, so no chance collision of keys can
remove a byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, join_totals, mapped, row_key, row_slices, text_bytes
from .words import _powers, mixed

WIDTH = 200
GRAM = 64
WINDOW_GRAMS = WIDTH - GRAM + 1
# Bytes hashed at once; bytes of regions in one suffix array; regions of an anchor sorted in one task.
STEP_BYTES = 1 << 18
ARRAY_BYTES = 1 << 18
# Bytes of texts (packed ones too) taken from an Arrow batch at a time.
TAKEN_BYTES = 1 << 20
SPLIT_OVER = 8192

# What is to be done with a region: remove it; compare it, the region having copies or none (MANY: its anchor has very many).
COVER, ASK, ASK_SINGLE, MANY = 0, 1, 2, 4


def _sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any stretch follows."""
    up, _ = _powers(len(data))
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


def _hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _powers(len(sums))
    return mixed((sums[end] - sums[start]) * down[start])


def _region_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    place = (end - start).astype(np.uint64) << np.uint64(32) | (anchor - start).astype(np.uint64)
    return mixed(_hashes(sums, start, end) + mixed(place))


@dataclass
class Regions:
    """Anchors of texts: text number, gram hash, region hash, region start, end and the anchor's place in the text."""

    text: np.ndarray
    gram: np.ndarray
    region: np.ndarray
    start: np.ndarray
    end: np.ndarray
    place: np.ndarray


def regions(texts: list[bytes]) -> Iterator[Regions]:
    """The regions of all windows of the texts, some texts at a time."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= STEP_BYTES):
            size += len(texts[last])
            last += 1
        begins = np.concatenate([[0], np.cumsum([len(t) for t in texts[first:last]])])
        found = _regions(np.frombuffer(b"".join(texts[first:last]), np.uint8), begins)
        if found is not None:
            found.text += first
            yield found
        first = last


def _regions(data: np.ndarray, begins: np.ndarray) -> Regions | None:
    n = len(data)
    if n < WIDTH:
        return None
    sums = _sums(data)
    grams = np.arange(n - GRAM + 1)
    hashes = _hashes(sums, grams, grams + GRAM)
    # The upper half of the hash, then the place: the least is the leftmost of the least hashes.
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | grams.astype(np.uint64)
    width = 1
    while 2 * width <= WINDOW_GRAMS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = WINDOW_GRAMS - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    windows = np.arange(n - WIDTH + 1)
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))[:len(windows)]
    inside = windows + WIDTH <= begins[owner + 1]
    windows, owner = windows[inside], owner[inside]
    if not len(windows):
        return None
    place = (least[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])
    at = np.flatnonzero(new)
    start, end = windows[at], windows[np.append(at[1:], len(windows)) - 1] + WIDTH
    place, owner = place[at], owner[at]
    region = _region_hash(sums, start, end, place)
    return Regions(owner, hashes[place], region, start - begins[owner], end - begins[owner], place - begins[owner])


# ---- the enhanced suffix array of one task's regions

BLOCK = 7  # bytes ranked first: packed with their number into eight


def repeat_groups(strings: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, strings, offsets) of each maximal repeat of ``WIDTH`` bytes or more.

    The occurrences are all suffixes of the strings that begin with the repeat;
    they don't all have the same byte to their left (a string's first byte has
    none), and no longer common prefix.
    """
    lengths = np.array([len(s) for s in strings], np.int64)
    begins = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(strings), np.uint8)
    n = len(data)
    owner = np.repeat(np.arange(len(strings)), lengths)
    left = (begins + lengths)[owner] - np.arange(n)  # bytes to the end of the string
    suffixes = np.flatnonzero(left >= WIDTH)
    if len(suffixes) < 2:
        return
    ranks = _ranks(data, left)
    top = max(ranks)
    keys = [np.where(left[suffixes] > i * top, ranks[top][np.minimum(suffixes + i * top, n - 1)], -1)
            for i in range(-(-int(lengths.max()) // top))]
    order = np.lexsort(keys[::-1])
    array = suffixes[order]  # the suffix array
    common = _common_prefixes(array, ranks, left, data)  # of each suffix with the one before it
    before = np.where(array > begins[owner[array]], data[array - 1].astype(np.int64), -1)
    yield from _intervals(array, common, before, owner, begins)


def _ranks(data: np.ndarray, left: np.ndarray) -> dict[int, np.ndarray]:
    """Rank of the next ``length`` bytes at each place, by prefix doubling; strings end before others go on."""
    n = len(data)
    packed = np.zeros(n, np.uint64)
    for i in range(BLOCK):
        own = np.zeros(n, np.uint64)
        own[:n - i] = data[i:]
        packed |= np.where(left > i, own, 0).astype(np.uint64) << np.uint64(8 * (BLOCK - i))
    packed |= np.minimum(left, BLOCK).astype(np.uint64)
    ranks = {BLOCK: np.unique(packed, return_inverse=True)[1].astype(np.int64)}
    length = BLOCK
    while 2 * length <= WIDTH:
        rank = ranks[length]
        after = np.zeros(n, np.int64)
        after[:n - length] = rank[length:] + 1
        after[left <= length] = 0
        ranks[2 * length] = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        length *= 2
    return ranks


def _common_prefixes(array: np.ndarray, ranks: dict[int, np.ndarray], left: np.ndarray, data: np.ndarray) -> np.ndarray:
    common = np.zeros(len(array), np.int64)
    a, b = array[:-1], array[1:]
    most = np.minimum(left[a], left[b])
    got = np.zeros(len(a), np.int64)
    top = max(ranks)
    for length in [top] * (-(-int(left.max()) // top)) + sorted(ranks, reverse=True)[1:] + [1] * BLOCK:
        fits = np.flatnonzero(got + length <= most)
        values = data if length == 1 else ranks[length]
        same = values[a[fits] + got[fits]] == values[b[fits] + got[fits]]
        got[fits[same]] += length
    common[1:] = got
    return common


def _intervals(array: np.ndarray, common: np.ndarray, before: np.ndarray, owner: np.ndarray, begins: np.ndarray,
               ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Stack scan: each interval [i, j] of suffixes whose least common prefix is ``WIDTH`` or more, children first."""
    n = len(array)
    # Runs that can hold a maximal repeat: those not all preceded by one byte.
    apart = np.flatnonzero(common < WIDTH)
    edges = np.append(apart, n)
    low, high = np.minimum.reduceat(before, apart), np.maximum.reduceat(before, apart)
    for r in np.flatnonzero((np.diff(edges) > 1) & ((low != high) | (low < 0))):
        s, e = int(edges[r]), int(edges[r + 1])
        prefix = common[s:e].tolist()
        stack: list[tuple[int, int]] = []  # (length, first suffix of the interval)
        for i in range(1, e - s + 1):
            length = prefix[i] if i < e - s else WIDTH - 1
            first = i - 1
            while stack and stack[-1][0] > length:
                deepest, first = stack.pop()
                rows = slice(s + first, s + i)
                preceding = before[rows]
                if (preceding < 0).any() or (preceding != preceding[0]).any():
                    members = owner[array[rows]]
                    yield deepest, members, array[rows] - begins[members]
            if length >= WIDTH and (not stack or stack[-1][0] < length):
                stack.append((length, first))


# ---- the Spark job

# A region's place in its text, packed into one number: start, size, the anchor's place in the region.
SIZE_BITS, AT_BITS = 12, 8


def _packed(start: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (start << SIZE_BITS | size) << AT_BITS | at


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rest = place >> AT_BITS
    return rest >> SIZE_BITS, rest & ((1 << SIZE_BITS) - 1), place & ((1 << AT_BITS) - 1)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()],
                                      names=list(columns))


def _taken(batches, column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from row_slices(batch, TAKEN_BYTES, column)


def _grams(batches):
    for batch in _taken(batches, "text"):
        for found in regions(list(text_bytes(batch))):
            yield _batch(gram=found.gram.view(np.int64))


def _all_regions(batches):
    for batch in _taken(batches, "text"):
        rid = batch.column("rid").to_numpy()
        for found in regions(list(text_bytes(batch))):
            yield _batch(gram=found.gram.view(np.int64), region=found.region.view(np.int64), rid=rid[found.text],
                         place=_packed(found.start, found.end - found.start, found.place - found.start))


def _stored(batches):
    """Texts that can hold a repeat travel compressed; the others are done."""
    pack = zstandard.ZstdCompressor(level=1)
    for batch in _taken(batches, "text"):
        own = list(text_bytes(batch))
        yield _batch(rid=batch.column("rid"), doc_id=batch.column("doc_id"), n_bytes=[len(t) for t in own],
                     sha256=[hashlib.sha256(t).hexdigest() for t in own],
                     packed=pa.array([pack.compress(t) if len(t) >= WIDTH else None for t in own], pa.binary()))


def _unions(spans: np.ndarray) -> np.ndarray:
    """Sorted rows (start, end) of the spans' union; touching ones are one."""
    if not len(spans):
        return np.empty((0, 2), np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    last = np.append(np.flatnonzero(new)[1:], len(spans)) - 1
    return np.stack([spans[new, 0], reach[last]], 1)


def _kept_hash(text: bytes, spans: np.ndarray) -> str:
    kept, at = hashlib.sha256(), 0
    for a, b in spans.tolist():
        kept.update(text[at:a])
        at = b
    kept.update(text[at:])
    return kept.hexdigest()


def _verified(text: bytes, todo: pa.Array) -> tuple[np.ndarray, ...]:
    """kind, gram, start, end of the region rows that have their hash in the text."""
    kind, gram, region, place = (todo.field(c).to_numpy() for c in ("kind", "gram", "region", "place"))
    start, size, at = _unpacked(place)
    end = start + size
    good = end <= len(text)
    kind, gram, region, start, end, at = (x[good] for x in (kind, gram, region, start, end, at))
    sums = _sums(np.frombuffer(text, np.uint8))
    same = _region_hash(sums, start, end, start + at).view(np.int64) == region
    return kind[same], gram[same], start[same], end[same]


def _half(batches):
    """Whole-region spans applied; texts with regions still to be compared go on."""
    unpack = zstandard.ZstdDecompressor()
    for batch in _taken(batches, "packed"):
        todo, packed = batch.column("todo"), batch.column("packed")
        n = batch.num_rows
        sha, spans, asks = batch.column("sha256").to_pylist(), [b""] * n, [None] * n
        going = [None] * n
        for i in range(n):
            if not todo[i].is_valid or not packed[i].is_valid:
                continue
            data = packed[i].as_py()
            text = unpack.decompress(data)
            kind, gram, start, end = _verified(text, todo[i].values)
            cover = _unions(np.stack([start, end], 1)[kind == COVER])
            spans[i] = cover.tobytes()
            ask = kind != COVER
            if ask.any():
                asks[i] = np.stack([kind, gram, start, end], 1)[ask].astype(np.int64).tobytes()
                going[i] = data
            else:
                sha[i] = _kept_hash(text, cover)
        yield _batch(rid=batch.column("rid"), doc_id=batch.column("doc_id"), n_bytes=batch.column("n_bytes"),
                     sha256=sha, spans=pa.array(spans, pa.binary()), asks=pa.array(asks, pa.binary()),
                     packed=pa.array(going, pa.binary()))


def _asked(batches):
    """The bytes of each region to be compared."""
    unpack = zstandard.ZstdDecompressor()
    for batch in _taken(batches, "packed"):
        for rid, asks, packed in zip(*(batch.column(c).to_pylist() for c in ("rid", "asks", "packed"))):
            text = unpack.decompress(packed)
            kind, gram, start, end = np.frombuffer(asks, np.int64).reshape(-1, 4).T
            yield _batch(gram=gram, kind=kind, rid=np.full(len(gram), rid), start=start,
                         bytes=pa.array([text[a:b] for a, b in zip(start.tolist(), end.tolist())], pa.binary()))


def _sorted_groups(batches):
    """Maximal repeats of regions sorted by anchor: a suffix array for some anchors at a time."""
    def found(held: list[pa.Table]):
        table = pa.concat_tables(held)
        kind, rid, start = (table.column(c).to_numpy() for c in ("kind", "rid", "start"))
        out = [np.empty((0, 2), np.int64)]
        for length, member, offset in repeat_groups(table.column("bytes").to_pylist()):
            own = kind[member] == ASK_SINGLE  # the others are removed as whole regions
            at = (member[own] << SIZE_BITS) + offset[own]
            out.append(np.stack([at, at + length], 1))
        # Intervals lie within one another: what is removed of a region is their union.
        runs = _unions(np.concatenate(out))
        if len(runs):
            member = runs[:, 0] >> SIZE_BITS
            shift = start[member] - (member << SIZE_BITS)
            yield _batch(rid=rid[member], start=runs[:, 0] + shift, end=runs[:, 1] + shift)

    held, size, last = [], 0, None
    for batch in batches:
        grams = batch.column("gram").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(grams[1:] != grams[:-1]) + 1, [len(grams)]])
        sizes = np.add.reduceat([len(x) for x in batch.column("bytes").to_pylist()], cuts[:-1]) if len(grams) else []
        for a, b, own in zip(cuts[:-1], cuts[1:], sizes):
            if size + own > ARRAY_BYTES and held and grams[a] != last:
                yield from found(held)
                held, size = [], 0
            held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
            size += int(own)
            last = grams[a]
    if held:
        yield from found(held)


def _windows(batches):
    """Each window of the regions of an anchor that has very many."""
    for batch in batches:
        for gram, kind, rid, start, data in zip(*(batch.column(c).to_pylist() for c in ("gram", "kind", "rid", "start", "bytes"))):
            sums = _sums(np.frombuffer(data, np.uint8))
            at = np.arange(len(data) - WIDTH + 1)
            own = _hashes(sums, at, at + WIDTH) ^ mixed(np.array([gram]).view(np.uint64))
            yield _batch(window=own.view(np.int64), single=np.full(len(at), kind == ASK_SINGLE + MANY),
                         rid=np.full(len(at), rid), start=start + at)


def _final(batches):
    unpack = zstandard.ZstdDecompressor()
    for batch in _taken(batches, "packed"):
        sha, spans = batch.column("sha256").to_pylist(), batch.column("spans").to_pylist()
        more, packed = batch.column("more"), batch.column("packed")
        for i in range(batch.num_rows):
            if packed[i].is_valid:
                own = np.frombuffer(spans[i], np.int64).reshape(-1, 2)
                if more[i].is_valid:
                    new = more[i].values
                    own = np.concatenate([own, np.stack([new.field(c).to_numpy() for c in ("start", "end")], 1)])
                own = _unions(own)
                spans[i], sha[i] = own.tobytes(), _kept_hash(unpack.decompress(packed[i].as_py()), own)
        bounds = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in spans]
        flat = np.concatenate([*bounds, np.empty((0, 2), np.int64)])
        places = np.concatenate([[0], np.cumsum([len(b) for b in bounds])]).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["start", "end"])
        yield _batch(doc_id=batch.column("doc_id"), n_bytes=batch.column("n_bytes"),
                     spans=pa.ListArray.from_arrays(pa.array(places), pairs), kept_sha256=pa.array(sha))


def _region_rows(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, found, alike): rows of ``docs`` with their key ``rid``; every region whose anchor
    occurs twice, stored; and its distinct regions with their number and one occurrence."""
    rows = docs.select("doc_id", "text", F.xxhash64(row_key(F.col("doc_id"), F.col("text"))).alias("rid"))
    twice = mapped(rows.select("text"), _grams, "gram long").groupBy("gram").count().where("count > 1").select("gram")
    every = mapped(rows.select("rid", "text"), _all_regions, "gram long, region long, rid long, place long")
    found = checkpointed(every.join(twice, "gram"))
    alike = found.groupBy("gram", "region").agg(F.count("*").alias("n"), F.min(F.struct("rid", "place")).alias("one"))
    return rows, found, alike


def removed_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept_sha256) per row of ``docs``.

    ``spans`` are the removed runs of bytes (start, end exclusive), in order and
    apart from one another; ``kept_sha256`` is the hash of the other bytes. A
    null text is empty; texts under ``WIDTH`` bytes lose nothing; a row that
    repeats a longer text as a whole loses all of it, as do all its copies. Texts
    of any length are taken as a whole; an empty table gives no rows; other
    columns don't matter, whatever their names.
    """
    rows, found, alike = _region_rows(docs)
    kind = dict(rows.dtypes)["doc_id"]
    several = alike.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1")
    whole = (found.join(alike.where("n > 1").select("gram", "region"), ["gram", "region"])
             .select("rid", F.lit(COVER).alias("kind"), "gram", "region", "place"))
    asks = alike.join(several, "gram").select(
        "one.rid", (F.when(F.col("n") > 1, ASK).otherwise(ASK_SINGLE) + F.when(F.col("m") > SPLIT_OVER, MANY).otherwise(0))
        .alias("kind"), "gram", "region", "one.place")
    todo = whole.unionAll(asks).groupBy("rid").agg(
        F.collect_set(F.struct(F.col("kind").cast("long").alias("kind"), "gram", "region", "place")).alias("todo"))

    stored = mapped(rows, _stored, f"rid long, doc_id {kind}, n_bytes long, sha256 string, packed binary")
    half = checkpointed(mapped(stored.join(todo, "rid", "left"), _half,
                               f"rid long, doc_id {kind}, n_bytes long, sha256 string, spans binary, asks binary, packed binary"))
    asked = mapped(half.where("asks IS NOT NULL").select("rid", "asks", "packed"), _asked,
                   "gram long, kind long, rid long, start long, bytes binary")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = asked.where(F.col("kind") < MANY).repartition(parts, "gram").sortWithinPartitions("gram")
    by_array = mapped(few, _sorted_groups, "rid long, start long, end long")
    windows = mapped(asked.where(F.col("kind") >= MANY), _windows, "window long, single boolean, rid long, start long")
    shared = windows.groupBy("window").count().where("count > 1").select("window")
    by_window = (windows.where("single").join(shared, "window")
                 .select("rid", "start", (F.col("start") + WIDTH).alias("end")))
    more = by_array.unionAll(by_window).groupBy("rid").agg(F.collect_set(F.struct("start", "end")).alias("more"))
    return mapped(half.join(more, "rid", "left"), _final,
                  f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept_sha256 string")


# ---- the groups themselves

def _region_bytes(batches):
    """The bytes of each region to be compared, where the text has its hash."""
    for batch in _taken(batches, "text"):
        for text, todo in zip(text_bytes(batch), batch.column("todo")):
            gram, region, place = (todo.values.field(c).to_numpy() for c in ("gram", "region", "place"))
            start, size, at = _unpacked(place)
            sums = _sums(np.frombuffer(text, np.uint8))
            good = _region_hash(sums, start, start + size, start + at).view(np.int64) == region
            yield _batch(gram=gram[good], region=region[good], bytes=pa.array(
                [text[a:a + n] for a, n in zip(start[good].tolist(), size[good].tolist())], pa.binary()))


def _held_anchors(batches, key: str = "gram"):
    """Tables of all rows of some anchors, from batches sorted by anchor."""
    held, size, last = [], 0, None
    for batch in batches:
        grams = batch.column(key).to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(grams[1:] != grams[:-1]) + 1, [len(grams)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if a < b:
                if size > ARRAY_BYTES and grams[a] != last:
                    yield pa.concat_tables(held)
                    held, size = [], 0
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
                size += held[-1].nbytes
                last = grams[a]
    if held:
        yield pa.concat_tables(held)


def _interval_members(batches):
    """(grp, length, gram, region, shift): the regions and places in them of each interval's occurrences."""
    for table in _held_anchors(batches):
        gram, region = (table.column(c).to_numpy() for c in ("gram", "region"))
        for length, member, offset in repeat_groups(table.column("bytes").to_pylist()):
            name = hashlib.md5(np.array([length, gram[member[0]], region[member[0]], offset[0]], np.int64).tobytes()).digest()
            yield _batch(grp=pa.array([name] * len(member), pa.binary()), length=np.full(len(member), length, np.int64),
                         gram=gram[member], region=region[member], shift=offset.astype(np.int64))


def _window_members(batches):
    """The same of an anchor that very many regions have: each window is a string of its own."""
    for batch in batches:
        for gram, region, data in zip(*(batch.column(c).to_pylist() for c in ("gram", "region", "bytes"))):
            sums = _sums(np.frombuffer(data, np.uint8))
            at = np.arange(len(data) - WIDTH + 1)
            own = mixed(_hashes(sums, at, at + WIDTH) ^ mixed(np.array([gram]).view(np.uint64)))
            yield _batch(grp=pa.array([x.tobytes() for x in own], pa.binary()), length=np.full(len(at), WIDTH, np.int64),
                         gram=np.full(len(at), gram), region=np.full(len(at), region), shift=at)


def repeats(docs: DataFrame) -> DataFrame:
    """(group_id, length, n, doc_id, start): every occurrence of each maximal repeat found, one row each.

    The ``length`` bytes from ``start`` on are the same in all ``n`` rows of a
    group, and are nowhere else. Groups come from the suffix arrays' intervals
    (left-extension tested), whole regions with copies, and, for anchors in over
    ``SPLIT_OVER`` regions, windows; a region's representative stands for all
    rows that hold it. Groups that have the same occurrences at a constant
    distance and touch or overlap are one, so a repeat longer than a region comes
    out whole unless parts of it occur elsewhere, too; such parts are groups of
    their own. Null and short texts are in no group; repeated rows are separate
    occurrences; other columns don't matter, and an empty table has no groups.
    """
    rows, found, alike = _region_rows(docs)
    kind = dict(rows.dtypes)["doc_id"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    several = alike.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1")
    asks = alike.join(several, "gram").select("one.rid", "gram", "region", "one.place", (F.col("m") > SPLIT_OVER).alias("many"))

    def members(many: bool, function) -> DataFrame:
        own = asks.where(F.col("many") == many)
        todo = own.groupBy("rid").agg(F.collect_set(F.struct("gram", "region", "place")).alias("todo"))
        texts = rows.dropDuplicates(["rid"]).join(todo, "rid").select("text", "todo")
        data = mapped(texts, _region_bytes, "gram long, region long, bytes binary")
        dealt = data if many else data.repartition(parts, "gram").sortWithinPartitions("gram")
        return mapped(dealt, function, "grp binary, length long, gram long, region long, shift long")

    inside = checkpointed(members(False, _interval_members))
    windows = members(True, _window_members)
    size = F.expr(f"(one.place >> {AT_BITS}) & {(1 << SIZE_BITS) - 1}")
    crowded = asks.where("many").select("gram").distinct()
    whole = (alike.where("n > 1").select("gram", "region", size.alias("length"))
             .join(inside.where("shift = 0").select("gram", "region", "length"), ["gram", "region", "length"], "left_anti")
             .join(crowded, "gram", "left_anti")
             .select(F.md5(F.concat_ws(":", "gram", "region")).cast("binary").alias("grp"), "length", "gram", "region",
                     F.lit(0).cast("long").alias("shift")))
    placed = found.select("gram", "region", "rid", F.shiftright("place", AT_BITS + SIZE_BITS).alias("begin"))
    every = inside.unionByName(windows).unionByName(whole)
    occurring = checkpointed(every.join(placed, ["gram", "region"]).select(
        "grp", "length", "rid", (F.col("begin") + F.col("shift")).alias("start")))
    firsts = checkpointed(occurring.groupBy("grp").agg(
        F.first("length").alias("size"), F.count("*").alias("n"), F.min(F.struct("rid", "start")).alias("first")).where("n > 1"))
    # Groups with one shape have the same occurrences but for a constant distance.
    placing = F.xxhash64("rid", F.col("start") - F.col("first.start"))
    shapes = (join_totals(occurring.select("grp", "rid", "start"), firsts, "grp", "n").groupBy("grp", "size", "n", "first")
              .agg(F.sum(placing.cast("decimal(38,0)")).alias("shape")))
    same = Window.partitionBy("shape", "n", "first.rid").orderBy("first.start", F.col("size").desc(), "grp")
    reach = F.max(F.col("first.start") + F.col("size")).over(same.rowsBetween(Window.unboundedPreceding, -1))
    chained = shapes.withColumn("new", F.coalesce(F.col("first.start") > reach, F.lit(True)).cast("int"))
    chained = chained.withColumn("chain", F.sum("new").over(same))
    chains = (chained.groupBy("shape", "n", F.col("first.rid").alias("rid0"), "chain")
              .agg(F.min(F.struct("first.start", "grp")).alias("head"),
                   F.max(F.col("first.start") + F.col("size")).alias("end"))
              .select(F.col("head.grp").alias("grp"), "n", (F.col("end") - F.col("head.start")).alias("length")))
    out = join_totals(occurring.select("grp", "rid", "start"), checkpointed(chains), "grp", "n")
    ids = rows.groupBy("rid").agg(F.first("doc_id").alias("doc_id"))
    return out.join(ids, "rid").select(F.lower(F.hex("grp")).alias("group_id"), "length", "n",
                                       F.col("doc_id").cast(kind).alias("doc_id"), "start")
