"""Token ids of many texts, encoding each distinct word of a batch once.

The tokenizer drops white space and splits words from punctuation, so the ids of a text are
the ids of its words one after the other. Invented and compound words are many but repeat;
each is encoded once in a batch, and a word of letters only goes straight to the merges.
Words that repeat are kept for the batches that the same Python worker gets next.
"""

from __future__ import annotations

import functools
import unicodedata
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

TOKENIZER = "word_bpe_49k.json"
#: ASCII punctuation that the tokenizer always splits from letters before it; no apostrophe.
PUNCTUATION = ".,|!#$%&*+-/:;=?@\\^_`~()[]{}\"<>"
#: A text with this may hold a special token, which is matched before case is folded.
SPECIAL = "<|"
#: Words that a worker keeps from batch to batch, at most.
KEPT_WORDS = 200_000
#: Bytes of text encoded at a time; less repeats in fewer, more takes memory.
PART = 4_000_000


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def ends_in_letter(core: str) -> bool:
    """Whether what follows begins a run of symbols, and does not go on with one.

    The tokenizer takes symbols and marks of any script in one run. It composes and lower-cases
    first, and some letters (क़, İ) then end in a mark.
    """
    last = unicodedata.normalize("NFC", core[-1]).lower()[-1]
    return unicodedata.category(last)[0] in "LN"


class WordTokenizer:
    """Of a tokenizer that lower-cases, splits at white space and knows no word before."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.merges = self.whole.model
        self.bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.kept: dict[str, bytes] = {}

    def _letters(self, word: str) -> bytes:
        if not word.isascii():
            word = self.bytewise.pre_tokenize_str(word)[0][0]
        return array("I", [t.id for t in self.merges.tokenize(word)]).tobytes()

    def _whole(self, word: str) -> bytes:
        return array("I", self.whole.encode(word, add_special_tokens=False).ids).tobytes()

    def word_ids(self, word: str, cache: dict[str, bytes]) -> bytes:
        """Ids of one word, 32 bits each. cache: of its parts, letters and trailing punctuation."""
        if SPECIAL in word:
            return self._whole(word)
        if word.isascii() and word.isalpha() and word.islower():
            return self._letters(word)
        core = word.rstrip(PUNCTUATION)
        if core and not ends_in_letter(core):
            core = word
        found = b""
        for part in (core, word[len(core) :]):
            if part:
                if (ids := cache.get(part)) is None:
                    plain = part.isalpha() and part == part.lower()
                    plain = plain and unicodedata.is_normalized("NFC", part)
                    ids = cache[part] = self._letters(part) if plain else self._whole(part)
                found += ids
        return found

    def _encode_words(self, words: list[str], counts: np.ndarray) -> list[bytes]:
        parts: dict[str, bytes] = {}
        kept = self.kept
        found = [kept.get(w) or self.word_ids(w, parts) for w in words]
        if len(kept) + int((counts > 1).sum()) > KEPT_WORDS:
            kept.clear()
        repeated = np.flatnonzero(counts > 1)[:KEPT_WORDS].tolist()
        kept.update((words[i], found[i]) for i in repeated)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text begins in it (one more for the end)."""
        texts = pc.fill_null(texts, "")
        special = pc.match_substring(texts, SPECIAL)
        words = pc.ascii_split_whitespace(pc.if_else(special, texts, pc.ascii_lower(texts)))
        coded = words.flatten().dictionary_encode()
        word = coded.indices.to_numpy()
        distinct = coded.dictionary.to_pylist()
        lists = self._encode_words(distinct, np.bincount(word, minlength=len(distinct)))
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        flat = np.frombuffer(b"".join(lists), np.uint32)
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[word]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = flat[np.arange(ends[-1]) + np.repeat(starts[word] - ends[:-1], lengths)]
        return ids, ends[words.offsets.to_numpy()]


@functools.cache
def tokenizer_at(path: str) -> WordTokenizer:
    """One for each Python worker."""
    return WordTokenizer(path)


def chunks(sizes: Sequence[int], most: int = 8_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many bytes; a longer text is a range of its own."""
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def encoded(batch: pa.RecordBatch, path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """doc_id and ids of each row of a batch of doc_id and text."""
    doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for first, last in chunks(sizes, PART):
        ids, bounds = tokenizer_at(path).encode(texts.slice(first, last - first))
        for n, doc_id in enumerate(doc_ids[first:last]):
            yield doc_id, ids[bounds[n] : bounds[n + 1]]
