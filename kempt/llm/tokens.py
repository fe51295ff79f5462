"""Token ids of whole texts with a public tokenizer, one dictionary lookup per repeated word.

The tokenizer drops white space and never joins characters across it, nor a
letter with a mark, so a text's ids are the ids of such chunks in order.  Each distinct
chunk is encoded once per worker (in bulk, separated by a special token) and
looked up afterwards; when the dictionary reaches its bound, the half that was
met least is forgotten.
"""

from __future__ import annotations

import os
import re
from itertools import chain, repeat

import numpy as np

from kempt.llm.common import held

#: Texts are encoded in slices of about this many bytes: a slice's chunks are Python strings, many times its size.
SLICE_BYTES = 1 << 20
_SEPARATOR = "<|endoftext|>"
#: Chunks: what stands between blanks, cut also between a Latin letter and a mark, where the tokenizer always cuts.
_CHUNK = re.compile(r"(?:[^ \n\t\r.,;:!?#&*%$]++|[.,;:!?#&*%$]++[^ \n\t\r.,;:!?#&*%$]*+)"
                    r"(?:(?<![A-Za-zÀ-ÖØ-öø-ÿ])[.,;:!?#&*%$]++[^ \n\t\r.,;:!?#&*%$]*+)*+")


def _chunks(text: str) -> list[str]:
    """Chunks of a text, A-Z lower-cased as the tokenizer does it, but not where that could make a special token."""
    if "<|" not in text:
        text = text.lower() if text.isascii() else text.encode().lower().decode()
    return _CHUNK.findall(text)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... (count of them) for each entry, in order."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


class ChunkEncoder:
    """Encodes texts exactly as ``Tokenizer.encode(text, add_special_tokens=False)`` does."""

    def __init__(self, path: str, max_chunks: int = 200_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # lower-case Latin words are single words to the tokenizer: its model alone gives their ids
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(),
                                                            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.separator = self.tokenizer.token_to_id(_SEPARATOR)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        vocabulary = self.tokenizer.get_vocab()
        self.word_final = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_final[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.max_chunks = max_chunks
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, self.dtype)
        self.starts = np.zeros(1 << 16, np.int64)  # chunk i's ids: sizes[i] of them from starts[i]
        self.sizes = np.zeros(1 << 16, np.int64)
        self.n_ids = 0
        self.hits = np.zeros(1 << 16, np.int64)

    def _append(self, chunks: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        n, old = len(self.index), self.n_ids
        while len(self.sizes) < n + len(chunks):
            self.starts, self.sizes, self.hits = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes, self.hits))
        while len(self.ids) < old + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[old:old + len(ids)] = ids
        self.n_ids = old + len(ids)
        self.starts[n:n + len(chunks)] = old + np.cumsum(sizes) - sizes
        self.sizes[n:n + len(chunks)] = sizes
        self.index.update(zip(chunks, range(n, n + len(chunks))))

    def _shrink(self) -> None:
        """Forget the chunks that were met least: half of them stay."""
        n = len(self.index)
        kept = np.sort(np.argpartition(-self.hits[:n], n // 2)[:n // 2])
        chunks = np.fromiter(self.index, object, n)[kept].tolist()  # a dictionary keeps its order, which is that of the ids
        sizes, hits = self.sizes[kept], self.hits[kept] // 2
        ids = self.ids[ragged(self.starts[kept], sizes)]
        self._clear()
        self._append(chunks, sizes, ids)
        self.hits[:len(kept)] = hits

    def _learn(self, chunks: list[str]) -> None:
        """Bulk encoding: plain words are separated by blanks (a word ends at a word-final token), others by a special token."""
        plain_words, others, special = [], [], []
        for c in chunks:
            if c.isalpha() and (c.isascii() or (max(c) < "\u0250" and "\u0130" not in c)):
                plain_words.append(c)
            else:
                (special if "<|" in c else others).append(c)
        for chosen, plain in ((plain_words, True), (others, False)):
            for i in range(0, len(chosen), 4096):
                part = chosen[i:i + 4096]
                joined = " ".join(part).lower() if plain else _SEPARATOR.join(part)
                encode = (self.words if plain else self.tokenizer).encode_batch_fast
                ids = np.array(encode([joined], add_special_tokens=False)[0].ids, np.int64)
                if plain:
                    counts = np.diff(np.flatnonzero(self.word_final[ids]), prepend=-1)
                else:
                    counts = np.diff(np.concatenate([[-1], np.flatnonzero(ids == self.separator), [len(ids)]])) - 1
                    ids = ids[ids != self.separator]
                assert len(counts) == len(part)
                self._append(part, counts, ids)

        if special:
            ids = [self.tokenizer.encode(c, add_special_tokens=False).ids for c in special]
            self._append(special, np.array([len(x) for x in ids]), np.array(sum(ids, []), np.int64))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets with len(texts) + 1 entries); NULL is the empty text."""
        cut = [_chunks(t) if t else [] for t in texts]
        counts = [len(c) for c in cut]
        chunks = list(chain.from_iterable(cut))
        if len(self.index) > self.max_chunks:
            self._shrink()
        index = np.fromiter(map(self.index.get, chunks, repeat(-1)), np.int64, len(chunks))
        unknown = np.flatnonzero(index < 0).tolist()
        if unknown:
            self._learn(list({chunks[i] for i in unknown}))
            index[unknown] = [self.index[chunks[i]] for i in unknown]
        self.hits[:len(self.index)] += np.bincount(index, minlength=len(self.index))
        sizes = self.sizes[index]
        done = np.concatenate([[0], np.cumsum(sizes)])
        offsets = done[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        return self.ids[ragged(self.starts[index], sizes)], offsets


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file."""
    return held(("encoder", path), lambda: ChunkEncoder(path))


def public_path(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def default_tokenizer() -> str:
    """Path of the public word-level BPE vocabulary the queries use."""
    return public_path("word_bpe_49k.json")
