"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often each pair is linked.

A is a byte-level BPE of the tokenizers library, encoding a space and the text;
B is a sentencepiece model, which puts the space itself. Where tokens of both
end at one byte, a group of tokens ends; the last tokens of a group on either
side are linked. A pair's count is the number of its links in the whole corpus.

*Identity map.* An array gives for each A id the B id with the same bytes. A
group of one token on either side whose ids the map joins is counted in a vector
as long as A's vocabulary, one per task; the vectors are summed and, being of
bounded size, given to all tasks. Only the other, irregular groups' pairs enter
a shuffle, counted per batch beforehand. Pairs with over one in ``HOT_PAIRS`` of
all irregular links (at most ``HOT_PAIRS``) are given to the tasks as well, so
only links of rarer pairs, none of them a hot key, are joined with their counts.

Distinct units of texts (see ``units``; here they begin at blanks that no piece
of B holds after another character, so no token of either goes over a cut) are
aligned once per worker and kept.
"""

from __future__ import annotations

import hashlib
import os
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, mapped, row_slices
from .token_counts import VOCABULARY, encoder
from .units import (ASCII_BLANKS, LONG_UNIT, UnitTable, _padded, cut_table, distinct_units, encoded_units, spread,
                    starts, steps, text_buffers)

PIECES = "piece_bpe_32k.model"
STEP_BYTES = 1 << 22
# Pairs whose counts every task gets: at most so many have over one in so many of all links.
HOT_PAIRS = 1 << 16
CHUNK_BYTES = 1 << 15
OVERLAP_BYTES = 1 << 8
MARK = "▁"  # what stands for a space in pieces


class PieceEncoder:
    """Ids of B; ``tokens`` are the bytes of each id, ``blanks`` those at which a unit may begin."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        special = {i for i in range(len(pieces)) if self.model.is_control(i) or self.model.is_unknown(i)}
        self.tokens = [b"" if i in special else bytes([int(p[3:5], 16)]) if self.model.is_byte(i)
                       else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        plain = [t for i, t in enumerate(self.tokens) if not self.model.is_byte(i)]
        inside = {t[i] for t in plain for i in range(1, len(t)) if t[i] in ASCII_BLANKS and t[i - 1] not in ASCII_BLANKS}
        self.blanks = bytes(b for b in ASCII_BLANKS if b not in inside)
        if ord(" ") not in self.blanks:
            raise ValueError(f"{path}: pieces go on from a character to a blank")

    def batch(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts, each with a space put before it."""
        return self.model.encode(texts, num_threads=1)

    def long(self, data: bytes) -> np.ndarray:
        """Ids of a text of any length with a space put before it, from overlapping chunks.

        Left and right chunk are spliced at the end of a token that both have:
        neighbouring tokens of either chunk are a right pair, and a sequence of
        right pairs is the text's encoding (see ``splice``). If they have none,
        the right chunk begins earlier, at last with the text.
        """
        out, done, end = [], 0, self._border(data, CHUNK_BYTES)
        left = self._rows(data, 0, end)
        while end < len(data):
            further, overlap = self._border(data, end + CHUNK_BYTES), OVERLAP_BYTES
            while True:
                ends = left[left[:, 0] <= end - overlap, 0]
                start = next((p for p in ends[::-1].tolist() if data[p] & 0xC0 != 0x80), 0)
                if start <= done:
                    out, done, left = [], 0, self._rows(data, 0, further)
                    break
                right = self._rows(data, start, further)
                own = {row: j for j, row in enumerate(map(tuple, right.tolist()))}
                cut = next((k for k, row in enumerate(map(tuple, left.tolist())) if start < row[0] < end and row in own), None)
                if cut is not None:
                    out.append(left[:cut + 1, 1])
                    done = int(left[cut, 0])
                    left = right[own[tuple(left[cut].tolist())] + 1:]
                    break
                overlap *= 2
            end = further
        return np.concatenate([*out, left[:, 1]]).astype(np.int32)

    @staticmethod
    def _border(data: bytes, place: int) -> int:
        """The place, or the first one after it, where a character begins."""
        while place < len(data) and data[place] & 0xC0 == 0x80:
            place += 1
        return min(place, len(data))

    def _rows(self, data: bytes, start: int, end: int) -> np.ndarray:
        """Rows (end in the text, id) of the tokens of one chunk."""
        ids = np.array(self.model.encode(data[start:end].decode()), np.int64)
        return np.column_stack([np.cumsum(self.lengths[ids]) - 1 + start, ids])


class Aligner:
    """Groups and links of texts by two tokenizers; distinct units are aligned once and kept for the next batches.

    A link of ids that the identity map joins is the A id; another one is
    (A id + 1) * 2 ** 32 + B id.
    """

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = encoder(path_a, plain_special=True), PieceEncoder(path_b)
        by_bytes = {t: i for i, t in reversed(list(enumerate(self.b.tokens))) if t}
        by_bytes.update({t: i for i, t in enumerate(self.b.tokens) if t and not self.b.model.is_byte(i)})
        self.identity = np.array([by_bytes.get(t, -1) for t in token_bytes(self.a)], np.int64)
        self.cuts = cut_table(fine=False, blanks=self.b.blanks)
        self.kept = UnitTable(share=2)  # its groups are kept, too
        self.numbers = np.empty((0, 3), np.int64)  # A tokens, B tokens and groups of each kept unit; -1: can't be aligned
        self.begins, self.links = np.zeros(1, np.int64), np.empty(0, np.int64)
        self.written: list[bytes] = []  # its groups, spelled

    def aligned(self, column: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Of each text: A tokens, B tokens and groups, the groups spelled, and where its links begin (and the last's end); the links."""
        data, bounds = text_buffers(column)
        some = np.diff(bounds) > 0
        data = np.insert(data, bounds[:-1][some], ord(" "))
        bounds = bounds + np.concatenate([[0], np.cumsum(some)])
        at = starts(data, bounds, self.cuts)
        numbers, links, written = [np.empty((0, 3), np.int64)], [np.empty(0, np.int64)], []
        for part, own in steps(data, at):
            n, found, spelled = self._step(part, own)
            numbers.append(n)
            links.append(found)
            written += spelled
        numbers, links = np.concatenate(numbers), np.concatenate(links)
        first = np.searchsorted(at, bounds)
        before = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(np.maximum(numbers, 0), axis=0)])
        failed = np.concatenate([[0], np.cumsum(numbers[:, 0] < 0)])
        good = (np.diff(failed[first]) == 0) & some
        totals = np.where(good[:, None], np.diff(before[first], axis=0), 0)
        spelled = [b";".join(written[a:b]) if g else b"" for a, b, g in
                   zip(first[:-1].tolist(), first[1:].tolist(), good.tolist())]
        begin = before[first[:-1], 2]
        return totals, spelled, np.concatenate([[0], np.cumsum(totals[:, 2])]), links[spread(begin, totals[:, 2])]

    def _step(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        data, bounds, occurring = distinct_units(data, bounds)
        place, hashes = self.kept.find(data, bounds)
        fresh = np.flatnonzero(place < 0)
        size = np.diff(bounds)[fresh]
        new_data, new_bounds = data[spread(bounds[fresh], size)], np.concatenate([[0], np.cumsum(size)])
        new_numbers, new_links, new_written = self._new(new_data, new_bounds)
        n_kept = len(self.kept)
        place[fresh] = n_kept + np.arange(len(fresh))
        numbers = np.concatenate([self.numbers, new_numbers])
        begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(np.maximum(new_numbers[:, 2], 0))])
        links, written = np.concatenate([self.links, new_links]), self.written + new_written
        own = place[occurring]
        count = np.diff(begins)[own]
        out = numbers[own], links[spread(begins[own], count)], list(map(written.__getitem__, own.tolist()))
        added = self.kept.add(_padded(new_data), new_bounds, hashes[fresh])
        stay = np.concatenate([np.arange(n_kept), n_kept + added]) if len(added) < len(fresh) else None
        half = self.kept.keep()
        if half is not None:
            stay = half if stay is None else stay[half]
        if stay is not None:
            n = np.diff(begins)[stay]
            begins, links = np.concatenate([[0], np.cumsum(n)]), links[spread(begins[stay], n)]
            numbers, written = numbers[stay], list(map(written.__getitem__, stay.tolist()))
        self.numbers, self.begins, self.links, self.written = numbers, begins, links, written
        return out

    def _new(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        n = len(bounds) - 1
        size = np.diff(bounds)
        mark = np.frombuffer(MARK.encode(), np.uint8)
        marked = np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2]))
        good = np.ones(n, bool)
        good[np.searchsorted(bounds, marked, "right") - 1] = False  # B would take the mark for a space
        long = np.flatnonzero(good & (size > LONG_UNIT))
        short = np.flatnonzero(good & (size <= LONG_UNIT))
        rows, ids_a, ids_b, n_a, n_b = [], [], [], [], []
        own = spread(bounds[short], size[short])
        short_data, short_bounds = data[own], np.concatenate([[0], np.cumsum(size[short])])
        a, count_a = encoded_units(self._batch_a, self.a.lengths, short_data, short_bounds)
        b, count_b, fits = self._pieces(short_data, short_bounds)
        good[short[~fits]] = False
        rows, n_a, n_b = [short[fits]], [count_a[fits]], [count_b[fits]]
        ids_a, ids_b = [a[spread((np.cumsum(count_a) - count_a)[fits], count_a[fits])]], [b]
        for i in long.tolist():
            text = data[bounds[i]:bounds[i + 1]].tobytes()
            a, b = np.concatenate(list(self.a.splicer.ids(text.decode()))), self.b.long(text[1:])
            if b"".join(map(self.b.tokens.__getitem__, b.tolist())) != text:
                good[i] = False
                continue
            rows.append(np.array([i]))
            ids_a.append(a)
            ids_b.append(b)
            n_a.append([len(a)])
            n_b.append([len(b)])
        rows, ids_a, ids_b = np.concatenate(rows), np.concatenate(ids_a), np.concatenate(ids_b)
        numbers = np.full((n, 3), -1, np.int64)
        numbers[rows, 0], numbers[rows, 1] = np.concatenate(n_a), np.concatenate(n_b)
        links, groups, spelled = self._groups(ids_a, ids_b, np.cumsum(size[rows]))
        numbers[rows, 2] = groups
        written = [b""] * n
        for i, w in zip(rows.tolist(), spelled):
            written[i] = w
        # Links in the units' own order.
        begin, count = np.zeros(n, np.int64), np.maximum(numbers[:, 2], 0)
        begin[rows] = np.cumsum(groups) - groups
        return numbers, links[spread(begin, count)], written

    def _batch_a(self, texts: list[str]):
        return (e.ids for e in self.a.model.encode_batch_fast(texts, add_special_tokens=False))

    def _pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """B's ids of the units that it gives back byte by byte, how many each unit has, and which units these are."""
        def batch(texts):
            return self.b.batch([t[1:] for t in texts])

        raw = data.tobytes()
        try:
            ids, count = encoded_units(batch, self.b.lengths, data, bounds, first=" a")
            if b"".join(map(self.b.tokens.__getitem__, ids.tolist())) == raw:
                return ids, count, np.ones(len(count), bool)
        except ValueError:
            pass
        ids, count, fits = [np.empty(0, np.int32)], np.zeros(len(bounds) - 1, np.int64), np.zeros(len(bounds) - 1, bool)
        for i, (s, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):  # one by one, by a model that changes texts
            own = self.b.batch(["a" + raw[s:e].decode()])[0]
            if b"".join(map(self.b.tokens.__getitem__, own)) == b" a" + raw[s:e] and self.b.tokens[own[0]] == b" a":
                ids.append(np.array(own[1:], np.int32))
                count[i], fits[i] = len(own) - 1, True
        return np.concatenate(ids), count, fits

    def _groups(self, a: np.ndarray, b: np.ndarray, unit_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Links of units' tokens, one after the other, each unit's groups, and these spelled."""
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        link_a, link_b = a[last_a].astype(np.int64), b[last_b].astype(np.int64)
        single = (np.diff(last_a, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1)
        plain = single & (self.identity[link_a] == link_b)
        links = np.where(plain, link_a, (link_a + 1) << 32 | link_b)
        unit = np.searchsorted(unit_ends, ends)
        groups = np.bincount(unit, minlength=len(unit_ends))
        texts_a, texts_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        spelled, i, j = [], 0, 0
        for x, y in zip((last_a + 1).tolist(), (last_b + 1).tolist()):
            spelled.append(f"{','.join(texts_a[i:x])}|{','.join(texts_b[j:y])}")
            i, j = x, y
        bounds = [0, *np.cumsum(groups).tolist()]
        return links, groups, [";".join(spelled[s:e]).encode() for s, e in zip(bounds, bounds[1:])]


def token_bytes(own) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer of the tokenizers library."""
    from .bpe import byte_characters

    back = {c: b for b, c in byte_characters().items()}
    special = {i: t.content for i, t in own.model.get_added_tokens_decoder().items()}
    out = [b""] * own.model.get_vocab_size()
    for spelling, i in own.model.get_vocab().items():
        out[i] = special[i].encode() if i in special else bytes(back[c] for c in spelling)
    return out


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker and pair of files, on one thread (Spark runs the tasks side by side)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Aligner(path_a, path_b)


def _links(batch: pa.RecordBatch, column: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The stored links of a batch's rows, one after the other, and where each row's begin (and the last's end)."""
    unpack = zstandard.ZstdDecompressor()
    parts = [np.frombuffer(unpack.decompress(x), kind) for x in batch.column(column).to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return np.concatenate([np.empty(0, kind), *parts]).astype(np.int64), bounds


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    before = np.concatenate([[0], np.cumsum(values)])
    return np.diff(before[bounds])


def groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(rid, doc_id, n_a, n_b, n_groups, groups_sha256, same, pairs), one row per row of ``docs``, stored.

    ``same`` holds the A ids of the links that the identity map joins, ``pairs``
    the other links, both compressed. ``groups_sha256`` is the hash of the
    groups spelled as ``a1,a2|b1;a3|b2``, '' without tokens.
    """
    path_a, path_b = path_a or public_tokenizers.path(VOCABULARY), path_b or public_tokenizers.path(PIECES)
    slim = docs.select("doc_id", "text")

    def rows(batches):
        rid = TaskContext.get().partitionId() << 40
        own, pack = aligner(path_a, path_b), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in row_slices(batch, STEP_BYTES):
                totals, spelled, bounds, links = own.aligned(part.column("text"))
                same, pairs = [], []
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    one = links[a:b]
                    plain = one < 1 << 32
                    same.append(pack.compress(one[plain].astype("<u4").tobytes()))
                    pairs.append(pack.compress(one[~plain].astype("<i8").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid + np.arange(part.num_rows)), part.column("doc_id"), *map(pa.array, totals.T),
                     pa.array([hashlib.sha256(s).hexdigest() if s else "" for s in spelled]),
                     pa.array(same, pa.binary()), pa.array(pairs, pa.binary())],
                    names=["rid", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "same", "pairs"])
                rid += part.num_rows

    kind = dict(slim.dtypes)["doc_id"]
    return checkpointed(mapped(slim, rows, f"rid long, doc_id {kind}, n_a long, n_b long, n_groups long, "
                                           "groups_sha256 string, same binary, pairs binary"))


def pair_counts(stored: DataFrame, n_ids: int) -> DataFrame:
    """(pair, n), stored: how many links hold each pair; a pair below 2 ** 32 is an A id and its B id by the identity map."""
    def rows(batches):
        total = np.zeros(n_ids, np.int64)  # the task's vector
        for batch in batches:
            for part in row_slices(batch, STEP_BYTES, "pairs"):
                total += np.bincount(_links(part, "same", "<u4")[0], minlength=n_ids)
                pair, n = np.unique(_links(part, "pairs", "<i8")[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], names=["pair", "n"])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["pair", "n"])

    found = mapped(stored.select("same", "pairs"), rows, "pair long, n long")
    return checkpointed(found.groupBy("pair").agg(F.sum("n").alias("n")))


def linked(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``.

    ``n_best`` counts the links whose pair has the highest count of all pairs
    with its B id, ties included; ``count_sum`` sums the counts over the links.
    Texts that are null or empty, or that B does not give back byte by byte,
    have no tokens: zeros and ''. Repeated rows have a row each and count as
    often as they come; an empty table gives no rows; texts are aligned as a
    whole, whatever their length; other columns don't matter.
    """
    path_a, path_b = path_a or public_tokenizers.path(VOCABULARY), path_b or public_tokenizers.path(PIECES)
    spark = docs.sparkSession
    identity = aligner(path_a, path_b).identity
    stored = groups(docs, path_a, path_b)
    counts = pair_counts(stored, len(identity))
    plain, irregular = F.col("pair") < 1 << 32, F.col("pair") >= 1 << 32

    # Vectors as long as the vocabularies: the count of each A id by the identity map, the highest count of each B id.
    same = np.zeros(len(identity), np.int64)
    for r in counts.where(plain).collect():
        same[r.pair] = r.n
    best = np.zeros(max(int(identity.max(initial=0)) + 1, aligner(path_a, path_b).b.lengths.size), np.int64)
    known = identity >= 0
    np.maximum.at(best, identity[known], same[known])
    top = counts.where(irregular).groupBy(F.expr("pair & 4294967295").alias("b")).agg(F.max("n").alias("n"))
    for r in top.collect():
        best[r.b] = max(best[r.b], r.n)
    total = counts.where(irregular).agg(F.sum("n")).first()[0] or 0
    frequent = (F.col("n") * HOT_PAIRS > total) & irregular  # fewer than HOT_PAIRS pairs
    hot = np.array(sorted((r.pair, r.n) for r in counts.where(frequent).collect()), np.int64).reshape(-1, 2)
    shared = spark.sparkContext.broadcast((same, best, np.where(known, same == best[identity], False), hot))

    def looked_up(pairs: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """The count of each pair, 0 for one that is not hot."""
        if not len(hot):
            return np.zeros(len(pairs), np.int64)
        at = np.minimum(np.searchsorted(hot[:, 0], pairs), len(hot) - 1)
        return np.where(hot[at, 0] == pairs, hot[at, 1], 0)

    def known_sums(batches):
        same, best, is_best, hot = shared.value
        for batch in batches:
            for part in row_slices(batch, STEP_BYTES, "pairs"):
                ids, id_bounds = _links(part, "same", "<u4")
                pairs, bounds = _links(part, "pairs", "<i8")
                n = looked_up(pairs, hot)
                n_best = _sums(is_best[ids], id_bounds) + _sums((n > 0) & (n == best[pairs & 0xFFFFFFFF]), bounds)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:6], pa.array(np.diff(id_bounds) + np.diff(bounds)), pa.array(n_best.astype(np.int64)),
                     pa.array(_sums(same[ids], id_bounds) + _sums(n, bounds))],
                    names=[*part.schema.names[:6], "n_links", "hot_best", "hot_sum"])

    def rare_pairs(batches):
        hot = shared.value[3]
        for batch in batches:
            for part in row_slices(batch, STEP_BYTES, "pairs"):
                pairs, bounds = _links(part, "pairs", "<i8")
                rare = np.flatnonzero(looked_up(pairs, hot) == 0)
                row = np.searchsorted(bounds, rare, "right") - 1
                own, times = np.unique(np.stack([row, pairs[rare]]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rid").take(pa.array(own[0])), pa.array(own[1]), pa.array(times.astype(np.int64))],
                    names=["rid", "pair", "times"])

    kind = dict(docs.select("doc_id").dtypes)["doc_id"]
    first = mapped(stored, known_sums, f"rid long, doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, "
                                       "n_links long, hot_best long, hot_sum long")
    rare = mapped(stored.select("rid", "pairs"), rare_pairs, "rid long, pair long, times long")
    highest = spark.createDataFrame([(i, n) for i, n in enumerate(best.tolist()) if n], "b long, top long")
    cold = (counts.where(irregular & ~frequent).withColumn("b", F.expr("pair & 4294967295"))
            .join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("is_best")))
    sums = (rare.join(cold, "pair").groupBy("rid")
            .agg(F.sum(F.col("times") * F.col("n")).alias("rare_sum"), F.sum(F.col("times") * F.col("is_best")).alias("rare_best")))

    def both(name: str):
        return (F.col(f"hot_{name}") + F.coalesce(f"rare_{name}", F.lit(0))).cast("long")

    return first.join(sums, "rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", both("best").alias("n_best"), both("sum").alias("count_sum"),
        "groups_sha256")
