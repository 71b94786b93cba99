"""Token ids of whole texts with the ``tokenizers`` library inside Arrow batches.

Both encoders part a text by their pattern, whose matches never change each
other's ids, and hold what the library made of each match; a new match goes
through the library. Texts with characters from U+0250 on, where tables of
letters may differ between libraries, are parted at blanks and such words go
through the library whole.
"""

from __future__ import annotations

import base64
import os
from array import array
from functools import lru_cache

#: Matches of the pattern, and words with other characters, held by one worker;
#: two tables of each kind at most are alive.
HELD_PIECES = 200_000
HELD_WORDS = 50_000
#: Longer pieces are encoded each time.
HELD_LENGTH = 40
#: All tables of letters, digits and blanks agree below this character.
SURE = "\u0250"


def library():
    """The tokenizers module without threads of its own: Spark's tasks use the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers
    return tokenizers


def byte_characters() -> list[str]:
    """Byte -> its character in byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others take the code points from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def sure_pattern(pattern: str):
    """``findall`` of a pattern in which \\p{L}, \\p{N}, \\s and \\S stand inside or
    outside classes, for texts below SURE (and the mark that a lower-cased capital may end with)."""
    import re
    import unicodedata
    known = [chr(c) for c in range(ord(SURE))] + ["\u0307"]
    spell = lambda chars: "".join(f"\\u{ord(c):04x}" for c in chars)
    letters = spell(c for c in known if unicodedata.category(c)[0] == "L")
    numbers = spell(c for c in known if unicodedata.category(c)[0] == "N")
    blanks = spell("\t\n\x0b\x0c\r \x85\xa0")
    for inside, chars in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\s", blanks)):
        pattern = re.sub(r"\[[^\]]*\]", lambda m: m[0].replace(inside, chars), pattern).replace(inside, f"[{chars}]")
    return re.compile(pattern.replace(r"\S", f"[^{blanks}]")).findall


def beyond_sure():
    """Search for a character from SURE on."""
    import re
    return re.compile(f"[{SURE}-\U0010ffff]").search


class Held(dict):
    """piece -> what ``encode`` makes of it; the least recent half is forgotten beyond a bound."""

    def __init__(self, encode, bound: int = HELD_PIECES):
        super().__init__()
        self.encode, self.bound, self.old = encode, bound, {}

    def __missing__(self, piece: str):
        found = self.old.get(piece)
        if found is None:
            found = self.encode(piece)
        if len(piece) <= HELD_LENGTH:
            if len(self) >= self.bound:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found


def rest(*tables: Held) -> None:
    """At the end of a task: an idle worker keeps the recent pieces alone."""
    for t in tables:
        t.old = {}


class WordEncoder:
    """The word-ending BPE of a ``tokenizers`` file: lower case, white space dropped.

    Ids equal ``Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids``.
    """

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        self.tokenizer = library().Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.split, self.beyond = sure_pattern(self.PATTERN), beyond_sure()
        self.table = dict(enumerate(byte_characters()))
        # ids as bytes, ready to be joined
        self.four = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.words = Held(self._word, HELD_WORDS)
        self.pieces = Held(self._piece)

    def _sure(self, text: str) -> bytes:
        # such a text is its own normal form, and what is lower case is beyond doubt
        return b"".join(map(self.pieces.__getitem__, self.split(text.lower())))

    def _word(self, word: str) -> bytes:
        if "<|" not in word and not self.beyond(word):
            return self._sure(word)
        return b"".join(map(self.four.__getitem__, self.tokenizer.encode(word, add_special_tokens=False).ids))

    def _piece(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isprintable()  # such bytes stand for themselves
        coded = piece if plain else piece.encode("utf-8").decode("latin-1").translate(self.table)
        four = self.four
        return b"".join([four[t.id] for t in self.tokenize(coded)])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if "<|" not in text and not self.beyond(text):
            return self._sure(text)
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and file."""
    return WordEncoder(path)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def last_merge(ranks: dict[bytes, int], token: bytes) -> tuple[bytes, bytes] | None:
    """The two parts whose merge makes ``token``: lower ranks merge first."""
    parts, top = [token[i:i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, at = min(((ranks.get(parts[i] + parts[i + 1], top), i) for i in range(len(parts) - 1)))
        if rank >= top:
            return None
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


class ByteEncoder:
    """Byte-level BPE by a rank file, run by the ``tokenizers`` library."""

    def __init__(self, path: str, pattern: str):
        import re
        t = library()
        ranks = read_ranks(path)
        chars = byte_characters()
        self.chars = chars
        spell = lambda token: "".join(chars[b] for b in token)
        order = sorted(ranks, key=ranks.get)
        merges = [(spell(p[0]), spell(p[1])) for token in order if len(token) > 1 and (p := last_merge(ranks, token))]
        model = t.models.BPE(vocab={spell(k): v for k, v in ranks.items()}, merges=merges, ignore_merges=True)
        self.tokenizer = t.Tokenizer(model)
        self.tokenize = self.tokenizer.model.tokenize
        self.tokenizer.pre_tokenizer = t.pre_tokenizers.Sequence([
            t.pre_tokenizers.Split(t.Regex(pattern), behavior="isolated"),
            t.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        back = {c: b for b, c in enumerate(chars)}
        # decoding reverses the byte table: id -> the bytes that its characters stand for
        self.bytes_of = {i: bytes(back[c] for c in token) for token, i in self.tokenizer.get_vocab().items()}
        self.digits = {i: str(i) for i in self.bytes_of}
        self.blanks = re.compile(r"\s\s").search
        self.split, self.beyond = sure_pattern(pattern), beyond_sure()
        self.table = dict(enumerate(chars))
        self.words = Held(self._word, HELD_WORDS)
        self.pieces = Held(self._piece)

    def _made(self, ids: list[int]) -> tuple:
        """(ids, how many, as decimals, decoded) of one match or word."""
        return tuple(ids), len(ids), ",".join(map(self.digits.__getitem__, ids)), self.decode(ids)

    def _word(self, word: str) -> list[tuple]:
        if not self.beyond(word):
            return [self.pieces[p] for p in self.split(word)]
        return [self._made(self.tokenizer.encode(word, add_special_tokens=False).ids)]

    def _piece(self, piece: str) -> tuple:
        coded = piece.encode("utf-8").decode("latin-1").translate(self.table)
        return self._made([t.id for t in self.tokenize(coded)])

    def parts(self, text: str) -> list[tuple]:
        """What ``_made`` holds of each part of the text in order."""
        if not self.beyond(text):
            return list(map(self.pieces.__getitem__, self.split(text)))
        if self.blanks(text):
            return [self._made(self.tokenizer.encode(text, add_special_tokens=False).ids)]
        # where no two blanks meet, every match of the pattern lies between two spaces
        head, *rest = text.split(" ")
        return [part for word in [head, *[" " + w for w in rest]] for part in self.words[word]]

    def encode(self, text: str) -> list[int]:
        return [i for ids, *_ in self.parts(text) for i in ids]

    def digest(self, text: str) -> tuple[int, str, bytes]:
        """(number of ids, the ids as decimals joined by commas, the decoded bytes)."""
        parts = self.parts(text)
        if not parts:
            return 0, "", b""
        _, n, digits, decoded = zip(*parts)
        return sum(n), ",".join(filter(None, digits)), b"".join(decoded)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def offsets(self, text: str, ids) -> list[tuple[int, int]]:
        """For each id the characters [start, stop) that its bytes touch.

        A character whose bytes are split between ids lies in the span of each.
        """
        out, at = [], 0
        coded = text.encode("utf-8")
        char_at, n = [], -1
        for b in coded:
            n += (b & 0xC0) != 0x80
            char_at.append(n)
        for i in ids:
            size = len(self.bytes_of[i])
            out.append((char_at[at], char_at[at + size - 1] + 1))
            at += size
        return out


@lru_cache(maxsize=2)
def byte_encoder(path: str, pattern: str) -> ByteEncoder:
    return ByteEncoder(path, pattern)


def whole_characters(parts):
    """Texts of a stream of byte strings: bytes of an unfinished character wait for the next part."""
    import codecs
    decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
    for part in parts:
        yield decoder.decode(part)
    yield decoder.decode(b"", True)
