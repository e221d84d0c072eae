"""Token ids of the public tokenizer files, faster than by their own library.

The ids are those of the ``tokenizers`` library. Its merge loop is replaced by
the one of ``tiktoken``, which joins neighbours whose *concatenation* ranks
lowest, not the listed pairs. Both end alike if every token of the vocabulary,
encoded alone, gives itself: symbols that tile a token's span have been merged
as they would be alone, so a pair that isn't listed for a token can't be left
to make it. Tokens that don't give themselves never appear, and are left out.
Whatever needs more than a plain merge (special strings, letters beyond Latin,
signs within words) goes to the ``tokenizers`` library itself.
"""

from __future__ import annotations

import re
from array import array
from itertools import chain

#: Words kept by a worker, of so many bytes at most (about 160 bytes each); the cache starts anew when it's full.
CACHE_WORDS, CACHE_BYTES = 600_000, 64
_encoders: dict = {}


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file, on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteEncoder:
    """The byte-level tokenizer: ``path`` its file, ``ranks`` the same vocabulary as a rank file."""

    def __init__(self, path: str, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self._encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> array:
        """A text's ids as unsigned 32-bit integers."""
        if any(s in text for s in self.special):
            return array("I", self.library.encode(text, add_special_tokens=False).ids)
        return array("I", self._encode(text))


#: The byte that stands for a word's end; UTF-8 has no such byte.
_END = b"\xff"
#: A Latin word and a run of ASCII signs other than apostrophes, which is a pre-token of its own.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")


class WordEncoder:
    """The tokenizer with word ends, which lower-cases and drops white space.

    Its normalisation never looks across white space, so a text is cut at ASCII
    white space and a word's ids are kept for the next time.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        by_sign = {s: bytes([b]) for b, s in _byte_signs().items()}
        merged = sorted(
            (i, b"".join(by_sign[c] for c in t.removesuffix("</w>")) + _END * t.endswith("</w>")) for t, i in vocabulary.items() if len(t.removesuffix("</w>")) > 1 and all(c in by_sign for c in t.removesuffix("</w>"))
        )
        singles = [bytes([b]) for b in range(256)]
        ranks = {t: r for r, t in enumerate([*singles, *(x + _END for x in singles if x != _END)])}
        rank = len(ranks)
        self.ids = [vocabulary.get(s, 0) for s in (_byte_signs()[b] for b in range(256))] + [vocabulary.get(_byte_signs()[b] + "</w>", 0) for b in range(255)]
        for i, t in merged:
            if t not in ranks:
                ranks[t] = rank
                self.ids.append(i)
                rank += 1
        self._piece = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.known: dict = {}
        self.fixed: dict = {}

    def by_library(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _word(self, word: bytes) -> list[int]:
        """The ids of a word without white space."""
        text, ids = word.decode(), self.ids
        if not text.isascii() and max(text) <= "ÿ":
            text = text.lower()
        if (parts := _PLAIN.fullmatch(text)) and "<|" not in text:
            return [ids[r] for part in parts.groups() if part for r in self._piece(part.encode() + _END)]
        return self.by_library(text)

    def word_ids(self, word: str) -> list[int]:
        return self._word(word.encode())

    def cut(self, text: str) -> list[bytes]:
        raw = text.encode()
        # Lower-casing first saves entries. It must not make a special string,
        # nor a letter that a combining mark (U+0300-036F) then composes with.
        if b"<|" not in raw and b"\xcc" not in raw and b"\xcd" not in raw:
            raw = raw.lower()
        return raw.split()

    def encode_batch(self, texts: list[str], make=lambda ids: array("H", ids).tobytes(), join=b"".join) -> list:
        """For each text, ``join`` of what ``make`` makes of each word's ids: here 16-bit integers."""
        cuts = [self.cut(text) for text in texts]
        missing = set(chain.from_iterable(cuts)).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > CACHE_WORDS:
                self.known = {w: x for w, x in self.known.items() if len(w) <= 7} | self.fixed  # short words recur
                missing = set(chain.from_iterable(cuts)).difference(self.known)
            self.known.update((w, make(self._word(w))) for w in missing)
        get = self.known.__getitem__
        out = [join(map(get, cut)) for cut in cuts]
        for w in missing:
            if len(w) > CACHE_BYTES:
                del self.known[w]
        return out

    def keep(self, fixed: dict[bytes, int]) -> None:
        """Words that are known once and for all."""
        self.fixed = fixed
        self.known.update(fixed)


def _byte_signs() -> dict[int, str]:
    """The printable sign that byte-level vocabularies use for each byte: itself, or one from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(others)) for b in range(256)}


def byte_encoder(path: str, ranks: str) -> ByteEncoder:
    """This worker's encoder for a file and its rank file, made once."""
    if (path, ranks) not in _encoders:
        _encoders[path, ranks] = ByteEncoder(path, ranks)
    return _encoders[path, ranks]


def word_encoder(path: str, use: str = "ids") -> WordEncoder:
    """This worker's encoder for a file, made once for each use."""
    if (path, use) not in _encoders:
        _encoders[path, use] = WordEncoder(path)
    return _encoders[path, use]
