"""Alignment of two tokenizers over the same texts: groups between common cuts, and linked token pairs.

Tokenizer A is a byte-level BPE of the tokenizers library and gets a blank
before the text; tokenizer B is a sentencepiece model, which adds that blank
itself.  Their spans are coarse cuts: A's character offsets, and the byte spans
of B's proto (the installed version offers the plain one, not the immutable
one).  Where A's characters are single bytes, and where no piece of B is a byte
fallback, these are the ends of the tokens; elsewhere the ends come from the
tokens' decoded bytes, so that characters of several bytes are cut inside.  A
text counts only if both tokenizers' bytes give it back.

Neither tokenizer has a token that goes on over a blank after a visible
character, or from a Latin letter to a mark, so a text is aligned piece by
piece between such places, and every distinct piece once per worker.  A text
with a piece that does not come back is aligned again as a whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm.common import held, materialise
from kempt.llm.tokens import ragged

#: Places that no token of either tokenizer goes over: after a visible character before a blank, line feed or tab, and
#: between a Latin letter and a mark.  ``Aligner`` checks its vocabulary for them.
_CUT = re.compile(r"(?<=\S)(?=[ \n\t])|(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[.,;:!?#&*%$])")
#: The same cuts, piece by piece: white space, then words that no mark follows and other characters, then one that a mark does.
_PIECE = re.compile(r"\s*+(?:[A-Za-zÀ-ÖØ-öø-ÿ]++(?![.,;:!?#&*%$])|[^\sA-Za-zÀ-ÖØ-öø-ÿ]++|[^\S \n\t]\s*+)*+"
                    r"(?:[A-Za-zÀ-ÖØ-öø-ÿ]++)?")
_HEAD = " a"
_FALLBACK = re.compile(r"<0x([0-9A-F]{2})>")
#: Bits of a B id in a pair code.
SHIFT = 24


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level BPE writes for each byte: itself, or the next code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Aligner:
    """Aligns texts by two tokenizer files; remembers distinct pieces up to a number."""

    def __init__(self, path_a: str, path_b: str, max_pieces: int = 300_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        self.bytes_a = {i: bytes(alphabet[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            hexed = _FALLBACK.fullmatch(piece) if self.b.is_byte(i) else None
            self.bytes_b.append(bytes([int(hexed[1], 16)]) if hexed else piece.replace("▁", " ").encode())
        self.is_byte = np.array([self.b.is_byte(i) for i in range(self.b.get_piece_size())], bool)
        self.sizes_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        self.sizes_a[list(self.bytes_a)] = [len(x) for x in self.bytes_a.values()]
        self.sizes_b = np.array([len(x) for x in self.bytes_b], np.int64)
        over = [p for p in (self.b.id_to_piece(i).replace("▁", " ") for i in range(self.b.get_piece_size())) if _CUT.search(p)]
        if over:
            raise ValueError(f"pieces go over a cut: {over[:5]}")
        self.names_a, self.names_b = (list(map(str, range(n))) for n in (len(self.sizes_a), len(self.sizes_b)))
        self.max_pieces = max_pieces
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.numbers = np.zeros((1 << 12, 5), np.int64)  # n_a, n_b, n_groups, n_links, whether the bytes come back
        self.codes = np.zeros(1 << 14, np.int64)
        self.ends = np.zeros((1 << 12) + 1, np.int64)

    def align(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Of a text that starts with a blank: A ids, the ends of their bytes, B ids, the ends of theirs; None if the bytes differ."""
        a = self.a.encode_batch([text], add_special_tokens=False)[0]
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        ids_a, ids_b = np.array(a.ids, np.int64), np.array([p.id for p in pieces], np.int64)
        raw = text.encode(errors="surrogatepass")
        if b"".join(map(self.bytes_a.get, a.ids)) != raw or b"".join(map(self.bytes_b.__getitem__, ids_b.tolist())) != raw:
            return None
        if len(raw) == len(text):  # single bytes: A's character offsets are byte offsets
            ends_a = np.array(a.offsets, np.int64)[:, 1]
        else:
            ends_a = np.cumsum(self.sizes_a[ids_a])
        if self.is_byte[ids_b].any():
            ends_b = np.cumsum(self.sizes_b[ids_b])
        else:  # spans in bytes, which do not count the blank before the text
            ends_b = np.array([p.end for p in pieces], np.int64) + 1
        return ids_a, ends_a, ids_b, ends_b

    @staticmethod
    def links(aligned: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ends of all overlaps, their pair codes, and the common cuts: between two neighbouring ends lie one A and one B token."""
        ids_a, ends_a, ids_b, ends_b = aligned
        ends = np.union1d(ends_a, ends_b)
        codes = ids_a[np.searchsorted(ends_a, ends)] << SHIFT | ids_b[np.searchsorted(ends_b, ends)]
        return ends, codes, np.intersect1d(ends_a, ends_b, assume_unique=True)

    def _group_texts(self, aligned: tuple, cuts: np.ndarray) -> list[str]:
        ids_a, ends_a, ids_b, ends_b = aligned
        a, b = [self.names_a[i] for i in ids_a.tolist()], [self.names_b[i] for i in ids_b.tolist()]
        at_a, at_b = (np.searchsorted(ends_a, cuts) + 1).tolist(), (np.searchsorted(ends_b, cuts) + 1).tolist()
        return [f"{a[i]}|{b[j]}" if k - i == m - j == 1 else f"{','.join(a[i:k])}|{','.join(b[j:m])}"
                for i, k, j, m in zip([0, *at_a], at_a, [0, *at_b], at_b)]

    def _entry(self, text: str) -> tuple[str, tuple, np.ndarray]:
        aligned = self.align(text)
        if aligned is None:
            return "", (0, 0, 0, 0, 0), np.zeros(0, np.int64)
        _, codes, cuts = self.links(aligned)
        return ";".join(self._group_texts(aligned, cuts)), (len(aligned[0]), len(aligned[2]), len(cuts), len(codes), 1), codes

    def _append(self, pieces: list[str], numbers: np.ndarray, codes: np.ndarray, groups: list[str]) -> None:
        n, old = len(self.index), int(self.ends[len(self.index)])
        while len(self.numbers) < n + len(pieces):
            self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)])
            self.ends = np.concatenate([self.ends, np.zeros(len(self.ends) - 1, np.int64)])
        while len(self.codes) < old + len(codes):
            self.codes = np.concatenate([self.codes, np.zeros_like(self.codes)])
        self.codes[old:old + len(codes)] = codes
        self.numbers[n:n + len(pieces)] = numbers
        self.ends[n + 1:n + len(pieces) + 1] = old + np.cumsum(numbers[:, 3])
        self.groups += groups
        self.index.update(zip(pieces, range(n, n + len(pieces))))

    def _learn(self, pieces: list[str]) -> None:
        """Align pieces in bulk, one after the other in one text, each after a visible character or a letter as in its own text."""
        for chosen in ([p for p in pieces if p.isascii()], [p for p in pieces if not p.isascii()]):
            for start in range(0, len(chosen), 1024):
                part = chosen[start:start + 1024]
                # a piece that ends in white space would run into the next one's blank
                joined = [p for p in part if not p[-1].isspace()]
                parts = [x for p in joined for x in ((p,) if p[0] in " \n\t" else (_HEAD, p))]
                aligned = self.align("".join([_HEAD, *parts])) if joined else None
                if aligned is not None:
                    ends, codes, cuts = self.links(aligned)
                    sizes = [len(p.encode(errors="surrogatepass")) for p in joined]
                    stops = np.cumsum(np.array([len(_HEAD) + n if p[0] not in " \n\t" else n for p, n in zip(joined, sizes)])) + len(_HEAD)
                    starts = stops - sizes
                    low, high = ([np.searchsorted(x, at) + 1 for x in (aligned[1], aligned[3], cuts, ends)] for at in (starts, stops))
                    numbers = np.stack([*(h - k for k, h in zip(low, high)), np.ones(len(joined), np.int64)], axis=1)
                    texts = self._group_texts(aligned, cuts)
                    self._append(joined, numbers, codes[ragged(low[3], numbers[:, 3])],
                                 [";".join(texts[i:k]) for i, k in zip(low[2].tolist(), high[2].tolist())])
                    part = [p for p in part if p[-1].isspace()]
                for p in part:
                    text, numbers, codes = self._entry(p) if p[0] == " " else ("", (0, 0, 0, 0, 0), np.zeros(0, np.int64))
                    self._append([p], np.array([numbers]), codes, [text])

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Per text: the five numbers and the groups; then the text of every link, and its pair's code."""
        cut = [_PIECE.findall(" " + t)[:-1] if t else [] for t in texts]  # the last match is empty
        counts = np.array([len(p) for p in cut], np.int64)
        flat = list(chain.from_iterable(cut))
        if len(self.index) > self.max_pieces:
            self._clear()
        new = set(flat).difference(self.index)
        if new:
            self._learn(sorted(new))
        at = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        first = np.concatenate([[0], np.cumsum(counts)])
        sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(self.numbers[at], axis=0)])
        numbers = sums[first[1:]] - sums[first[:-1]]
        whole = numbers[:, 4] == counts
        owner = np.repeat(np.arange(len(texts)), counts)
        used = whole[owner]
        sizes = np.where(used, self.ends[at + 1] - self.ends[at], 0)
        codes, of_text = self.codes[ragged(self.ends[at], sizes)], np.repeat(owner, sizes)
        groups = [";".join(map(self.groups.__getitem__, at[a:b].tolist())) if ok else ""
                  for a, b, ok in zip(first[:-1].tolist(), first[1:].tolist(), whole.tolist())]
        numbers[~whole] = 0
        more_codes, more_texts = [codes], [of_text]
        for i in np.flatnonzero(~whole).tolist():
            groups[i], numbers[i], own = self._entry(" " + texts[i])
            more_codes.append(own)
            more_texts.append(np.full(len(own), i))
        return numbers, groups, np.concatenate(more_texts), np.concatenate(more_codes)


def _align_rows(path_a: str, path_b: str, slice_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = held(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        for batch in batches:
            texts = batch.column(2).to_pylist()
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and high - low < 8192 and (high == low or size + len(texts[high] or "") <= slice_chars):
                    size += len(texts[high] or "")
                    high += 1
                numbers, groups, of_text, codes = aligner.texts(texts[low:high])
                pairs, times = np.unique(of_text << 2 * SHIFT | codes, return_counts=True)
                ends = np.searchsorted(pairs >> 2 * SHIFT, np.arange(high - low + 1)).astype(np.int32)
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low),
                     *[pa.array(np.ascontiguousarray(numbers[:, i])) for i in range(4)], pa.array(groups, pa.string()),
                     pa.ListArray.from_arrays(offsets, pa.array(pairs & ((1 << 2 * SHIFT) - 1))),
                     pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))],
                    names=["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])
                low = high

    return run


def align(docs: DataFrame, *, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          slice_chars: int = 1 << 20) -> DataFrame:
    """One row per document: a row number, the id, n_a, n_b, n_groups, n_links, ``groups``, and its linked pairs.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3`` in text order.  ``pairs`` holds the
    document's distinct linked pairs (A id << 24 | B id) and ``times`` how
    often each is linked in it.  NULL and empty texts, and texts whose bytes
    either tokenizer does not give back, have no tokens: zeros, empty groups
    and no pairs.  Repeated rows and ids are rows of their own; whole texts of
    any length are read; an empty table gives no rows; further columns are not
    read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_align_rows(path_a, path_b, slice_chars),
                           "rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
                           "pairs array<long>, times array<int>")


def _score_frequent(frequent):
    """Sums over the pairs of the broadcast table; the others are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = frequent.value
        for batch in batches:
            pairs, times = batch.column(1), batch.column(2)
            n = batch.num_rows
            owner = np.repeat(np.arange(n), np.diff(pairs.offsets.to_numpy()))
            p, t = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(codes, p), max(len(codes) - 1, 0))
            known = codes[at] == p if len(codes) else np.zeros(len(p), bool)
            n_best = np.zeros(n, np.int64)
            total = np.zeros(n, np.int64)
            np.add.at(n_best, owner[known], t[known] * best[at[known]])
            np.add.at(total, owner[known], t[known] * counts[at[known]])
            offsets = pa.array(np.searchsorted(owner[~known], np.arange(n + 1)).astype(np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_best), pa.array(total), pa.ListArray.from_arrays(offsets, pa.array(p[~known])),
                 pa.ListArray.from_arrays(offsets, pa.array(t[~known]))], names=["rid", "n_best", "count_sum", "pairs", "times"])

    return run


def link_scores(aligned: DataFrame, *, frequent: int = 1 << 17) -> DataFrame:
    """(rid, n_best, count_sum) of every row of a written ``align`` table.

    A pair's count is the number of rows that hold it.  The ``frequent`` most
    counted pairs are broadcast, a fixed number; every other pair is joined by
    a shuffle, and none of them is held by more than one in ``frequent`` of
    all (row, pair) entries, so no key of that join is hot.
    """
    spark = aligned.sparkSession
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = materialise(counts.withColumn("a", F.shiftright("pair", SHIFT)), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    table = materialise(counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best")), "pair-table")
    top = table.orderBy(F.desc("n"), "pair").limit(frequent).toArrow()
    order = np.argsort(top["pair"].to_numpy(), kind="stable")
    sent = spark.sparkContext.broadcast(tuple(top[c].to_numpy()[order].astype(np.int64) for c in ("pair", "n", "best")))
    scored = materialise(aligned.select("rid", "pairs", "times").mapInArrow(
        _score_frequent(sent), "rid long, n_best long, count_sum long, pairs array<long>, times array<long>"), "pair-scores")
    rest = scored.select("rid", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("rid", F.col("l.pairs").alias("pair"), "l.times")
    rest = (rest.join(table, "pair").groupBy("rid")
            .agg(F.sum(F.col("times") * F.col("best")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    return (scored.select("rid", "n_best", "count_sum").join(rest, "rid", "left")
            .select("rid", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                    (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum")))
