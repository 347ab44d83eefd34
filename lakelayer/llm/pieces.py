"""Token ids of whole texts by a ``tokenizers`` file, each distinct word encoded once.

Byte-pair merges never cross the pre-tokenizer's boundaries, so a text's ids are
the concatenation of the ids of its space-delimited pieces. A worker therefore
keeps the ids of the pieces it has met and asks the library only for new ones.
The shortcut is used for texts of ordinary characters with ordinary spacing and
without a string of the file's added tokens (as ``<|endoftext|>``); any other text is
encoded whole by the library, so both give the same ids.
"""

from __future__ import annotations

import json
import re
import struct

from tokenizers import Tokenizer

#: Pieces kept per generation; two generations live in a worker. Only speed depends on it.
CACHE_PIECES = 400_000
#: Bytes of texts with no special treatment in either pre-tokenizer or normalizer: new line,
#: printable ASCII, Latin-1 letters and Latin Extended-A (two bytes each), but not U+0130.
_PLAIN = bytes([0x0A, *range(0x20, 0x7F), 0xC3, 0xC4, 0xC5, *range(0x80, 0xC0)])
_NOT_PLAIN = b"\xc4\xb0"
#: White-space runs that a byte-level pre-tokenizer joins or splits by context.
_ODD_SPACING = ("  ", " \n", "\n ", "\n\n\n")
_TAIL = ".,;:!?"


def _byte_letters() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies: a printable
    Latin-1 character stands for itself, the others follow from U+0100 in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


class _Pieces(dict):
    """Ids (little-endian unsigned 32-bit, as bytes) of a piece; filled when first asked for."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.limit, self.compute = limit, compute
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.compute(piece)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class TextEncoder:
    """Encodes whole texts with the tokenizer file at ``path`` as the library does by
    default: an added token's string in a text gives that token; none are added."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        model = spec.get("model") or {}
        self.kind = None
        if model.get("type") == "BPE" and not model.get("dropout"):
            if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec.get("normalizer"):
                self.kind = "byte"
            elif model.get("end_of_word_suffix") and [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
                self.kind = "word"
        # White space and case may differ where tokens are looked for in the normalized text.
        added = [r"\s+".join(map(re.escape, re.split(r"\s+", t["content"]))) for t in spec.get("added_tokens") or []]
        loose = any(t.get("normalized") for t in spec.get("added_tokens") or [])
        self.added = re.compile("|".join(added) or r"(?!)", re.IGNORECASE if loose else 0)
        # Most texts lack the sign that every added token has, and need no search.
        signs = [next((c for c in t["content"] if not c.isspace() and c.upper() == c.lower()), "") for t in spec.get("added_tokens") or []]
        self.signs = set(signs) if all(signs) else {""}
        self.letters = dict(enumerate(_byte_letters()))
        self.pieces = _Pieces(self._byte_piece if self.kind == "byte" else self._word_piece, cache_pieces)

    @property
    def vocab_size(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters_only(self, word: str, lead: str) -> bytes:
        mapped = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return _packed([t.id for t in self.tokenizer.model.tokenize(lead + mapped)])

    def _parted(self, piece: str, mark: str) -> bytes | None:
        """A word with punctuation behind it is put together from the two."""
        core = piece.rstrip(_TAIL)
        if core != piece and core and core[-1].isalpha():
            return self.pieces[core] + self.pieces[mark + piece[len(core):]]
        return None

    def _word_piece(self, piece: str) -> bytes:
        if piece.isalpha():
            return self._letters_only(piece.lower(), "")
        return self._parted(piece, "") or self.whole(piece)

    def _byte_piece(self, piece: str) -> bytes:
        # A piece stands after a space, unless a NUL marks that none precedes it.
        bare = piece[:1] == "\0"
        word = piece[bare:]
        if word.isalpha():
            return self._letters_only(word, "" if bare else self.letters[0x20])
        if word in ("", "\n"):
            return self.whole(word)
        return self._parted(piece, "\0") or self.whole(word if bare else " " + word)

    def encode(self, text: str | None) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers; null and empty give none."""
        if not text:
            return b""
        if any(sign in text for sign in self.signs) and self.added.search(text):
            return self.whole(text)
        raw = text.encode()
        if self.kind is None or raw.translate(None, _PLAIN) or _NOT_PLAIN in raw:
            return self.whole(text)
        if self.kind == "word":
            return b"".join(map(self.pieces.__getitem__, text.split()))
        if any(gap in text for gap in _ODD_SPACING) or text[0] == " " or text[-1] == " " or text.endswith("\n\n"):
            return self.whole(text)
        return b"".join(map(self.pieces.__getitem__, ("\0" + text.replace("\n", " \n \0")).split(" ")))


_PACKERS = [struct.Struct(f"<{n}I").pack for n in range(40)]


def _packed(ids: list[int]) -> bytes:
    return _PACKERS[len(ids)](*ids) if len(ids) < 40 else struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[tuple[str, int], TextEncoder] = {}


def encoder(path: str, cache_pieces: int = CACHE_PIECES) -> TextEncoder:
    """One encoder per Python worker, file and size of the cache, kept between tasks."""
    key = (path, cache_pieces)
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(path, cache_pieces)
    return _ENCODERS[key]
