"""Word-wise encoding of whole texts with the public tokenizers.

A text is cut only where the tokenizer itself always cuts, so the words' ids put together are exactly the text's ids;
words repeat, so each worker keeps a bounded cache of them. The vocabulary of a tokenizers file is compiled for
tiktoken, which encodes a list of new words in one call. Words that could be read in another way (other scripts than
Latin, special strings, odd white space) and texts where a cut could matter go to the tokenizers library as they are.
``tests/llm`` hold all paths against the plain library.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable
from itertools import chain, compress

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bounds of a worker's cache; it starts anew beyond them.
MAX_WORDS, MAX_CHARS = 1_000_000, 20_000_000
#: Characters of text whose unknown words are encoded in one call.
STRETCH = 200_000
#: The value of words that need their text encoded whole.
WHOLE = "whole"
#: Ends a piece in what tiktoken gets; texts that hold it are encoded whole.
MARK = "\x01"
#: New words in one call of tiktoken.
CALL = 1000


class _Words:
    """A bounded cache from word to value."""

    #: Words of this kind's cache, if fewer than MAX_WORDS.
    most: int | None = None

    def __init__(self, start: dict | None = None):
        self.start = start or {}
        self.known: dict = dict(self.start)
        self.chars = 0

    def encode_words(self, words: list[str]) -> list:
        raise NotImplementedError

    def encode_whole(self, text: str):
        raise NotImplementedError

    def split(self, text: str) -> list[str]:
        raise NotImplementedError

    def join(self, values: list):
        raise NotImplementedError

    def each(self, texts: Iterable[str | None]):
        """The value of every text, in order; null counts as empty."""
        stretch, chars = [], 0
        for text in texts:
            stretch.append(text or "")
            chars += len(stretch[-1])
            if chars >= STRETCH:
                yield from self._stretch(stretch)
                stretch, chars = [], 0
        yield from self._stretch(stretch)

    def _stretch(self, texts: list[str]):
        cut = [self.split(x) for x in texts]
        words = list(chain.from_iterable(cut))
        if len(self.known) + len(words) // 8 > (self.most or MAX_WORDS) or self.chars > MAX_CHARS:
            self.known, self.chars = dict(self.start), 0
        values = list(map(self.known.get, words))
        unknown = [i for i, v in enumerate(values) if v is None] if None in values else []
        if unknown:
            new = list({words[i] for i in unknown})
            self.known.update(zip(new, self.encode_words(new), strict=True))
            self.chars += sum(map(len, new))
            for i in unknown:
                values[i] = self.known[words[i]]
        at = 0
        for text, own in zip(texts, cut, strict=True):
            try:
                yield self.join(values[at : at + len(own)])
            except TypeError:
                yield self.encode_whole(text)
            at += len(own)


def _byte_of_char() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones for themselves, then the rest."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table = {chr(b): b for b in own}
    table |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    return table


class _Bpe(_Words):
    """Values are the ids as little-endian unsigned 32-bit integers."""

    #: The vocabulary's suffix of the last token of a piece, if it has one.
    ENDS: str

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.ends_piece = np.zeros(max(model["vocab"].values()) + 1, bool)
        self.fast = self._compile(model)

    def _compile(self, model: dict):
        """tiktoken's encoder of the vocabulary, if merges have their order as ids, as tiktoken takes it; else None."""
        import tiktoken

        byte = _byte_of_char()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        first = model["vocab"]["".join(merges[0])]
        if [model["vocab"]["".join(m)] for m in merges] != list(range(first, first + len(merges))):
            return None
        if (model.get("end_of_word_suffix") or "") != self.ENDS:
            return None
        ranks = {}
        for token, i in model["vocab"].items():
            last = bool(self.ENDS) and token.endswith(self.ENDS)
            data = bytes(byte[c] for c in (token[: -len(self.ENDS)] if last else token))
            ranks[data + MARK.encode() * last] = i
            self.ends_piece[i] = last
        if self.ENDS:
            # the mark by itself is always merged with the byte before it, so its number is never given out
            ranks.setdefault(MARK.encode(), len(ranks))
        return tiktoken.Encoding("own", pat_str=self.PIECES, mergeable_ranks=ranks, special_tokens={})

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_whole(self, text: str) -> bytes:
        return self.ids([text])[0]

    def join(self, values: list) -> bytes:
        return b"".join(values)


def _cut_at(ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """The bytes of ids from each start to the next."""
    data = ids.astype("<u4").tobytes()
    edges = [*(starts * 4).tolist(), len(data)]
    return [data[a:b] for a, b in zip(edges, edges[1:], strict=False)]


class SpacedBpe(_Bpe):
    """Byte-level BPE whose words take the blank before them; cut before single blanks and single line ends.

    Words: the text's first, then each with its blank left out, or with the line end before it. The first gets a mark.
    """

    FIRST = "\x00"
    ENDS = ""
    most = 600_000  # workers of a pipeline also hold other stages' memory
    PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        super().__init__(path)
        blank = {c for c, b in _byte_of_char().items() if b == 32}
        self.starts_word = np.array([t[0] in blank for t, _ in sorted(self.library.get_vocab().items(), key=lambda x: x[1])])

    def split(self, text: str) -> list[str]:
        if self.FIRST in text:
            return [""]
        return (self.FIRST + text).replace("\n", " \n").split(" ") if text else []

    def encode_words(self, words: list[str]) -> list:
        out: list = [WHOLE] * len(words)
        plain, odd = [], []
        for i, w in enumerate(words):
            body = w[1:] if w[:1] in (self.FIRST, "\n") else w
            if body and not body[0].isspace() and not body[-1].isspace() and "<|" not in body:
                # a word of one call is known again by its blank, so only those without other white space go together
                (plain if body is w and self.fast and len(w.split()) == 1 else odd).append(i)
        for at in range(0, len(plain), CALL):
            part = plain[at : at + CALL]
            ids = np.array(self.fast.encode_ordinary(" " + " ".join([words[i] for i in part])), np.uint32)
            for i, data in zip(part, _cut_at(ids, np.flatnonzero(self.starts_word[ids])), strict=True):
                out[i] = data
        chunks = [words[i][1:] if words[i][0] == self.FIRST else words[i] if words[i][0] == "\n" else " " + words[i] for i in odd]
        for i, data in zip(odd, self.ids(chunks), strict=True):
            out[i] = data
        return out


class BareBpe(_Bpe):
    """BPE with word ends and white space dropped: cut at every blank and line end."""

    ENDS = "</w>"
    PIECES = rf"[^{MARK}]+{MARK}"
    #: Letters beyond ASCII that are never composed or changed but by lower(), character by character.
    LATIN = "".join(c for c in map(chr, range(0xC0, 0x180)) if c.isalpha() and c not in "İŉ")

    def __init__(self, path: str):
        import regex

        super().__init__(path)
        self.is_plain = regex.compile(rf"[!-~{self.LATIN}]+").fullmatch
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall

    def split(self, text: str) -> list[str]:
        return text.replace("\n", " ").split(" ")

    def encode_words(self, words: list[str]) -> list:
        out: list = [WHOLE] * len(words)
        plain = [bool(self.fast and self.is_plain(w) and "<|" not in w) for w in words]
        odd = [i for i, (p, w) in enumerate(zip(plain, words, strict=True)) if not p and "<|" not in w]
        numbers = list(compress(range(len(words)), plain))
        for at in range(0, len(numbers), CALL):
            part = numbers[at : at + CALL]
            lower = [words[i].lower() for i in part]
            cut = [[w] if w.isalpha() else self.pieces(w) for w in lower]
            ids = np.array(self.fast.encode_ordinary("".join([p + MARK for ps in cut for p in ps])), np.uint32)
            ends = np.flatnonzero(self.ends_piece[ids]) + 1  # of pieces
            last = np.cumsum([len(ps) for ps in cut])  # the words' last pieces
            for i, data in zip(part, _cut_at(ids, np.append(0, ends[last - 1][:-1])), strict=True):
                out[i] = data
        for i, data in zip(odd, self.ids([words[i] for i in odd]), strict=True):
            out[i] = data
        return out


class PieceCounts(_Words):
    """Numbers of sentencepiece pieces. A piece holds blanks at its start only and no line end, so cut before both."""

    def __init__(self, path: str, start: dict | None = None):
        import sentencepiece

        super().__init__(start)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)

    def split(self, text: str) -> list[str]:
        return text.replace("\n", " \n").split(" ") if text else []

    def encode_words(self, words: list[str]) -> list:
        def sure(w: str) -> bool:
            return bool(w) and "▁" not in w and "\x00" not in w and not (w[0] == "\n" and w[1:2].isspace())

        counts = iter(self.library.encode([w for w in words if sure(w)], num_threads=1))
        return [len(next(counts)) - (w[0] == "\n") if sure(w) else WHOLE for w in words]

    def encode_whole(self, text: str) -> int:
        return len(self.library.encode(text))

    def join(self, values: list) -> int:
        return sum(values)


_made: dict = {}


def encoder(kind: type, path: str, number: int = 0, *start) -> _Words:
    """This worker's encoder of a file; its cache lives on between tasks. number: that of start, a broadcast table; one is held."""
    if _made.get((kind, path), (None,))[0] != number:
        _made[kind, path] = number, kind(path, *start)
    return _made[kind, path][1]
