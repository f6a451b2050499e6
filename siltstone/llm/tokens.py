"""Token ids of many texts at once, as the tokenizers library gives them.

The vocabulary drops white space, so a text's ids are those of its words set
end to end. Words are told apart by ASCII white space, which no pre-token
crosses; other white space stays inside a word and is left to the library.
Each distinct word of a slice is encoded once and its ids are dealt to all
places by array indexing.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from siltstone.llm.textbytes import expanded

#: Words, and runs of letters, kept from slice to slice; about 150 bytes each.
KEPT_WORDS = 150_000

# One run of letters, perhaps with a comma or full stop: the library's pre-tokens are those two parts.
# The letters are of Latin-1, composed already, with lower case one to one.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary files lie on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {byte: chr(byte) for byte in shown}
    hidden = (byte for byte in range(256) if byte not in letters)
    return letters | {byte: chr(256 + n) for n, byte in enumerate(hidden)}


class Words:
    """Encodes and decodes with one vocabulary file; made once in each Python worker."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self._letters = _byte_letters()
        self._cores: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}
        size = self.library.get_vocab_size()
        self.texts = [self.library.id_to_token(i).encode() for i in range(size)]
        self._two = [i.to_bytes(2, "little") for i in range(size)]
        self._marks = {mark: self._pieces(mark) for mark in ".,"} | {"": b""}

    def _pieces(self, letters: str) -> bytes:
        # Each ASCII letter or mark stands for itself.
        shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self._letters)
        two = self._two
        return b"".join([two[t.id] for t in self.library.model.tokenize(shown)])

    def _new(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that no earlier slice kept."""
        cores, marks, new, odd = self._cores, self._marks, {}, []
        for word in words:
            if word.isalpha() and word.isascii():
                core, mark = word.lower(), ""
            elif plain := _PLAIN.fullmatch(word):
                core, mark = plain[1].lower(), plain[2]
            else:
                odd.append(word)
                continue
            found = cores.get(core)
            if found is None:
                found = self._pieces(core)
                if len(cores) < KEPT_WORDS:
                    cores[core] = found
            new[word] = found + marks[mark]
        encoded = self.library.encode_batch_fast(odd, add_special_tokens=False) if odd else []
        for word, encoding in zip(odd, encoded, strict=True):
            new[word] = np.array(encoding.ids, "<u2").tobytes()
        return new

    def _word_ids(self, words: list[str]) -> list[bytes]:
        known = self._words
        out = list(map(known.get, words))
        missing = [i for i, ids in enumerate(out) if ids is None]
        new = self._new([words[i] for i in missing])
        for i in missing:
            out[i] = new[words[i]]
        for word in new if len(known) < KEPT_WORDS else ():
            known[word] = new[word]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (one more entry); null is empty."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = split.flatten().dictionary_encode()
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]).astype(np.int64)
        pieces = self._word_ids(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 2
        flat = np.frombuffer(b"".join(pieces), "<u2")
        begins = np.cumsum(lengths) - lengths
        at = words.indices.to_numpy()
        counts = lengths[at]
        totals = np.concatenate([[0], np.cumsum(counts)])
        return flat[expanded(begins[at], counts)], totals[bounds]

    def encode_bytes(self, text: bytes) -> np.ndarray:
        """The ids of one text."""
        return np.frombuffer(b"".join(self._word_ids([w.decode() for w in text.split()])), "<u2")

    def decode(self, ids: np.ndarray) -> bytes:
        """What the library's ``decode(ids, skip_special_tokens=False)`` returns, in UTF-8.

        The file names no decoder, so it is the tokens with spaces between.
        """
        return b" ".join([self.texts[i] for i in ids.tolist()])


@cache
def words_of(path: str) -> Words:
    return Words(path)
