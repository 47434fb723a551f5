"""Token ids of whole texts as packed bytes, through a bounded cache of the pieces between single blanks.

Encoding a text piece by piece is exact where no token can reach over the place of a cut. A text is cut before each
blank that follows a character which is neither white space nor U+2581; a piece is encoded with its blank.

* Byte-level BPE files (.json) without normaliser, whose pre-tokenizer is the usual expression: none of its
  alternatives holds a blank after another character, so words never span a cut. A piece is divided into words by that
  expression, and each word, once while it is in a cache of its own, is tokenized by the library's model.
* BPE files with pieces (.model) without normalisation: no vocabulary entry has U+2581 after another character
  (checked when the file is loaded), so merges never span a cut. The library encodes each piece.

Every other file, and every piece that holds a special token's string, is given to the library as it is.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable

import numpy as np

BLANK = "▁"
#: Entries of a cache of pieces, and the longest text it keeps: at most about 100 MB. The cache of words has half as many.
MOST, LONGEST = 1 << 19, 64
# Fixed value: the public expression of byte-level pre-tokenizers.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for ASCII texts, in classes that the faster library knows.
_ASCII_WORDS = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: What a blank is not cut after: white space, all of it up to U+3000, and U+2581. The ASCII ones first.
_SPACES = [*filter(str.isspace, map(chr, range(0x3001))), BLANK]
_ASCII_SPACES = [c for c in _SPACES if c.isascii()]
_CUT = re.compile(rf" (?<=[^\s{BLANK}] )")


def _runs(text: str) -> bool:
    """Whether a blank follows white space or U+2581; most such characters are in no text, and looking for one is fast."""
    for c in _ASCII_SPACES if text.isascii() else _SPACES:
        if c in text and c + " " in text:
            return True
    return False


def pieces(text: str) -> list[str]:
    """The text between its cuts, without the blanks of the cuts."""
    return _CUT.split(text) if text.startswith(" ") or _runs(text) else text.split(" ")


class _Cache(dict):
    """text -> packed ids, in two generations of at most ``most`` entries together: what an older half has and is asked
    again moves to the younger one."""

    def __init__(self, encode: Callable[[str], bytes], most: int):
        super().__init__()
        self.encode, self.half, self.older = encode, max(1, most // 2), {}

    def __missing__(self, text: str) -> bytes:
        ids = self.older.get(text)
        if ids is None:
            ids = self.encode(text)
        if len(text) <= LONGEST:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids


def byte_characters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte: its own, else the next from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in own else next(rest)) for b in range(256)}


class Encoder:
    """Ids of a text by the tokenizer file at ``path``, without special tokens of its own, as packed little-endian numbers."""

    def __init__(self, path: str, specials_as_text: bool = False, most: int = MOST):
        self.most, self.dtype, self._code = most, np.dtype("<u2"), "H"
        if path.endswith(".json"):
            self._open_json(path, specials_as_text)
        elif path.endswith(".model"):
            self._open_model(path)
        else:
            raise ValueError(f"no library for {path}")
        if self.size > 1 << 16:
            self.dtype, self._code = np.dtype("<u4"), "I"
        self._cache = _Cache(self._after_blank, most)

    def pack(self, ids) -> bytes:
        return array(self._code, ids).tobytes()

    def _open_json(self, path: str, specials_as_text: bool) -> None:
        import regex
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        library.encode_special_tokens = specials_as_text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before, model = spec["pre_tokenizer"] or {}, spec["model"]
        self.exact_cuts = (
            not spec["normalizer"] and model["type"] == "BPE" and not model.get("dropout") and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before.get("add_prefix_space")
        )
        self.size = library.get_vocab_size()
        specials = [] if specials_as_text else [t["content"] for t in spec["added_tokens"]]
        characters, find, tokenize, pack = byte_characters(), regex.compile(WORDS).findall, library.model.tokenize, self.pack
        space = characters[0x20]

        def word(text: str) -> bytes:
            # Of printable ASCII characters the blank alone is written as another one.
            plain = text.isascii() and text.isprintable()
            written = text.replace(" ", space) if plain else text.encode().decode("latin-1").translate(characters)
            return pack([t.id for t in tokenize(written)])

        known = _Cache(word, self.most // 2)

        def whole(text: str) -> list[int]:
            return library.encode(text, add_special_tokens=False).ids

        def piece(text: str) -> bytes:
            for special in specials:
                if special in text:
                    return pack(whole(text))
            found = _ASCII_WORDS.findall(text) if text.isascii() else find(text)
            return b"".join(map(known.__getitem__, found))

        self._whole, self._head = whole, piece
        self._after_blank = lambda text: piece(" " + text)
        self.token_bytes = lambda: _byte_level(library.get_vocab())

    def _open_model(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(library.serialized_model_proto())
        normal, vocabulary = spec.normalizer_spec, [p.piece for p in spec.pieces]
        self.exact_cuts = (
            spec.trainer_spec.model_type == spec.trainer_spec.BPE and not normal.precompiled_charsmap and normal.add_dummy_prefix
            and not normal.remove_extra_whitespaces and normal.escape_whitespaces and not spec.trainer_spec.treat_whitespace_as_suffix
            and not any(p.type == p.USER_DEFINED for p in spec.pieces) and not any(BLANK in p.lstrip(BLANK) for p in vocabulary)
        )
        self.size = library.get_piece_size()
        blank = library.piece_to_id(BLANK)
        # The library itself puts a blank before a text, so the first piece is like all others.
        self._whole, self._head = library.encode, lambda text: self.pack(library.encode(text))
        self._after_blank = lambda text: self.pack(library.encode(text) if text else [blank])
        self.token_bytes = lambda: [_piece_bytes(p) for p in vocabulary]

    def encode(self, text: str, after_blank: bool = False) -> bytes:
        """Packed ids of ``text``, or of a blank and the text."""
        if not self.exact_cuts:
            return self.pack(self._whole(" " + text if after_blank else text))
        found = pieces(text)
        if after_blank:
            return b"".join(map(self._cache.__getitem__, found))
        return self._head(found[0]) + b"".join(map(self._cache.__getitem__, found[1:]))

    def encode_spaced(self, text: str) -> bytes:
        """Packed ids of the text where the library puts a blank before it itself; none for an empty text."""
        if not self.exact_cuts or not text:
            return self.pack(self._whole(text))
        return b"".join(map(self._cache.__getitem__, pieces(text)))


def _byte_level(vocabulary: dict[str, int]) -> list[bytes]:
    of = {ord(c): b for b, c in byte_characters().items()}
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, k in vocabulary.items():
        out[k] = bytes(of[ord(c)] for c in token) if all(ord(c) in of for c in token) else token.encode()
    return out


def _piece_bytes(piece: str) -> bytes:
    if re.fullmatch(r"<0x[0-9A-Fa-f]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(BLANK, " ").encode()


_loaded: dict[tuple, Encoder] = {}


def encoder(path: str, specials_as_text: bool = False, most: int = MOST) -> Encoder:
    """The process's encoder of a file."""
    key = (path, specials_as_text, most)
    if key not in _loaded:
        _loaded[key] = Encoder(*key)
    return _loaded[key]
