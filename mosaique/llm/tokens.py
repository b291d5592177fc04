"""Exact counts and ids of the public tokenizers, by distinct words.

Neither tokenizer lets a token cross certain boundaries (white space; before a run of word markers), so a text's ids
are those of its parts. Every distinct part of a slice of texts goes to the library once, and numpy lays the ids out.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from mosaique.llm.common import ascii_words, coded, per_row, split_at, spread

#: Letters that no normalisation joins to their neighbours, then ASCII marks but the apostrophe, which starts contractions.
PLAIN = r"^(?P<word>[a-zß-öø-ÿ]+)(?P<mark>[!-&(-/:-@\[-`{-~]*)$"
JOINED = 500
MARKER = "▁"


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Ids of a BPE with word ends that drops white space (the `tokenizers` library, no special tokens added)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        n = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(n)])

    def _each(self, texts: list[str], together: int) -> Iterator[np.ndarray]:
        """Ids of each text; the library's own objects, of some hundred bytes a token, live for few texts at once."""
        for at in range(0, len(texts), together):
            for x in self.tokenizer.encode_batch_fast(texts[at : at + together], add_special_tokens=False):
                yield np.array(x.ids, np.uint32)

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters or of marks only, and how many each has: one id of each ends the word."""
        texts = [" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        ids = np.concatenate([np.zeros(0, np.uint32), *self._each(texts, 16)])
        last = np.flatnonzero(self.ends[ids])
        return ids, np.diff(np.concatenate(([-1], last)))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets by text, and the ids of all texts."""
        offsets, words = ascii_words(pc.ascii_lower(pc.fill_null(texts, "")))
        codes, distinct = coded(words)
        parts = pc.extract_regex(distinct, PLAIN)
        plain = np.asarray(pc.is_valid(parts))
        at, units = coded(pa.concat_arrays([parts.field(0), parts.field(1)]).filter(pa.array(np.concatenate((plain, plain)))))
        units = units.to_pylist()
        ids, many = self._joined([x for x in units if x])
        count = np.zeros(len(units), np.int64)
        count[[i for i, x in enumerate(units) if x]] = many
        begin = np.cumsum(count) - count
        odd = list(self._each(distinct.filter(pa.array(~plain)).to_pylist(), 1000))
        n = int(plain.sum())
        # Ids of each distinct word: of its letters, then of its marks; or of the odd word as a whole.
        begins, counts = np.zeros((len(distinct), 2), np.int64), np.zeros((len(distinct), 2), np.int64)
        begins[plain] = np.stack((begin[at[:n]], begin[at[n:]]), 1)
        counts[plain] = np.stack((count[at[:n]], count[at[n:]]), 1)
        lengths = np.array([len(x) for x in odd], np.int64)
        begins[~plain, 0] = len(ids) + np.cumsum(lengths) - lengths
        counts[~plain, 0] = lengths
        pool = np.concatenate([ids, *odd])
        each = counts.sum(1)
        pool = pool[spread(begins.ravel(), counts.ravel())]
        first = np.cumsum(each) - each
        out = pool[spread(first[codes], each[codes])]
        return np.concatenate(([0], np.cumsum(per_row(each[codes], offsets)))), out.astype(np.uint32)


def marked_parts(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Parts of the texts in a sentence-piece form (a marker in front and for each space): cut before every run of
    markers, and around each line break and tab, which are parts of their own. An empty text or null has no part."""
    texts = pc.fill_null(texts, "")
    out = pc.binary_join_element_wise(pa.scalar(MARKER), pc.replace_substring(texts, " ", MARKER), "")
    out = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", out)
    out = pc.replace_substring_regex(out, f"({MARKER}+)", r" \1")
    out = pc.replace_substring_regex(out, r"([\n\t])", r" \1 ")
    return split_at(out, " ")


class PieceCounts:
    """How many ids a sentencepiece model gives, without begin, end or other added tokens."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        #: No piece holds a marker behind another character, a line break or a tab: then parts are independent.
        self.parted = not any(MARKER in x.lstrip(MARKER) or any(c in x for c in "\t\n") for x in pieces)
        self.parted &= self.whole(["a\n b"])[0] == self.whole(["a"])[0] + 1 + self.whole(["b"])[0]

    def whole(self, texts: list[str]) -> np.ndarray:
        return np.array([len(x) for x in self.model.encode(texts, num_threads=1)], np.int64)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        texts = pc.fill_null(texts, "")
        if not self.parted:
            return self.whole(texts.to_pylist())
        offsets, parts = marked_parts(texts)
        codes, distinct = coded(parts)
        # The library puts a marker in front: of a part with one, it stands for that; else, a line break keeps it apart.
        bare = np.array([not x.startswith(MARKER) for x in distinct.to_pylist()], bool)
        fed = ["\n" + x if b else x[1:] for x, b in zip(distinct.to_pylist(), bare, strict=True)]
        n = self.whole(fed) - 2 * bare if fed else np.zeros(0, np.int64)
        n = np.where(np.array([x == MARKER for x in distinct.to_pylist()], bool), 1, n) if fed else n
        return per_row(n[codes], offsets)
