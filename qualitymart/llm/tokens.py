"""Token ids of whole texts, equal to those of the tokenizers library and faster where that is safe.

A BPE file of one of two shapes (byte-level, or lower-cased words with an end-of-word mark) is also
loaded as byte ranks, which give the same ids for a fraction of the time. Texts in which the two
libraries might split characters differently (anything but common Latin letters and punctuation,
special strings, NUL, a capital sigma) go to the tokenizers library itself, as does every file of
another shape. The files are only read; their path is a parameter.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters on which the Unicode tables of all libraries agree, and whose lower case is known to them too.
PLAIN = re.compile("[\x01-ȳ‐-‧‰-⁞€]*")

# The patterns by which the two vocabularies split a text.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""

#: Unicode's white space among the plain characters; Python's ``\\s`` has four control characters more.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f"

END = "\x00"

#: Pre-tokens, and as many words, whose ids a worker remembers.
KNOWN = 1 << 18


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, by rule: printable
    Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def char_class(kinds: str) -> str:
    """Ranges of a regular expression's class: code points up to U+205E in the given categories."""
    points = [c for c in range(0x2060) if unicodedata.category(chr(c))[0] in kinds]
    runs: list[list[int]] = []
    for c in points:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)


def ranks(vocabulary: dict[str, int], merges: list, suffix: str) -> tuple[dict[bytes, int], np.ndarray]:
    """Byte ranks in merge order, and the vocabulary's id of each rank. An end-of-word mark is written as
    a NUL byte that joins the last byte before any other merge."""
    alphabet = byte_alphabet()
    shown = {b: c for c, b in alphabet.items()}

    def raw(piece: str) -> bytes:
        ends = bool(suffix) and piece.endswith(suffix)
        return bytes(alphabet[c] for c in (piece[: -len(suffix)] if ends else piece)) + END.encode() * ends

    names = [shown[b] for b in range(256)]
    if suffix:
        names += [n + suffix for n in names]
    names += ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
    found: dict[bytes, int] = {}
    ids = []
    for name in names:
        if found.setdefault(raw(name), len(ids)) == len(ids):
            ids.append(vocabulary[name])
    return found, np.array(ids, dtype=np.uint32)


class Library:
    """The tokenizers library as it is: special strings in a text count as their token, nothing is added."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.strings = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(f"({re.escape(s)})" for s in self.strings) or r"(?!)")
        self.size = self.tokenizer.get_vocab_size()
        alphabet = byte_alphabet()
        self.bytes_of = lambda shown: bytes(alphabet[c] for c in shown)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def ids_of_all(self, texts: list[str]) -> list[np.ndarray]:
        return [self.ids(text) for text in texts]

    def pretokens(self, text: str) -> list[str]:
        """The normalised pieces that merges never cross, special strings as pieces of their own."""
        found: list[str] = []
        at = 0
        for m in self.special.finditer(text):
            found += [*self._split(text[at : m.start()]), m[0]]
            at = m.end()
        return found + self._split(text[at:])

    def _split(self, text: str) -> list[str]:
        normalizer, splitter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        text = normalizer.normalize_str(text) if normalizer else text
        return [self.bytes_of(shown).decode() for shown, _ in splitter.pre_tokenize_str(text)]

    def pieces(self, pretokens: list[str]) -> list[int]:
        """How many ids each pre-token has."""
        return [len(e.ids) for e in self.tokenizer.encode_batch(pretokens, add_special_tokens=False)]


class Ranked(Library):
    """Ids through byte ranks, with the library for texts that aren't plain."""

    def __init__(self, path: str, config: dict, pattern: str):
        import tiktoken

        super().__init__(path)
        model = config["model"]
        found, self.id_of = ranks(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=found, special_tokens={})

    def plain(self, text: str) -> bool:
        return PLAIN.fullmatch(text) is not None and not any(s in text for s in self.strings)


class Bytes(Ranked):
    """Byte-level BPE: no normalisation, the space before a word belongs to it."""

    def __init__(self, path: str, config: dict):
        super().__init__(path, config, BYTE_PATTERN)
        import regex

        self.split = regex.compile(BYTE_PATTERN)

    def ids(self, text: str) -> np.ndarray:
        if not self.plain(text):
            return super().ids(text)
        return self.id_of[np.frombuffer(array("I", self.encoding.encode_ordinary(text)), dtype=np.uint32)]

    def pretokens(self, text: str) -> list[str]:
        return self.split.findall(text) if self.plain(text) else super().pretokens(text)


class Words(Ranked):
    """Lower-cased words with an end-of-word mark; white space is dropped."""

    def __init__(self, path: str, config: dict):
        super().__init__(path, config, f"[^{END}]+{END}")
        letters, digits = char_class("L"), char_class("N")
        self.split = re.compile(rf"[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d|[{digits}]|[^{SPACES}{letters}{digits}]+")
        self.control = re.compile("[\x1c-\x1f]")
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        by_rank = sorted(self.encoding.token_byte_values(), key=self.encoding.encode_single_token)
        self.ends = np.array([b.endswith(END.encode()) for b in by_rank])

    def pretokens(self, text: str) -> list[str]:
        if not self.plain(text):
            return super().pretokens(text)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return self.split.findall(text.lower())

    def ids(self, text: str) -> np.ndarray:
        return self.ids_of_all([text])[0]

    def ids_of_all(self, texts: list[str]) -> list[np.ndarray]:
        """Pre-tokens never hold white space, so words are told apart first, for all texts at once, and each distinct one
        is looked up or encoded once; its ids are then put where it occurs."""
        plain = [k for k, text in enumerate(texts) if self.plain(text) and not self.control.search(text)]
        out: list[np.ndarray | None] = [None] * len(texts)
        lower = [(texts[k] if texts[k].isascii() else unicodedata.normalize("NFC", texts[k])).lower() for k in plain]
        words = pc.utf8_split_whitespace(pa.array(lower, pa.large_string()))
        coded = words.flatten().dictionary_encode()
        parts = self._found(self.words, coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self._of_words)
        codes = coded.indices.to_numpy()
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        n = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(n)])
        shift = (np.cumsum(sizes) - sizes)[codes] - ends[:-1]
        ids = np.frombuffer(b"".join(parts), dtype=np.uint32)[np.repeat(shift, n) + np.arange(ends[-1])]
        cuts = ends[words.offsets.to_numpy()].tolist()
        for k, start, end in zip(plain, cuts, cuts[1:], strict=False):
            out[k] = ids[start:end]
        return [self._of_text(text) if found is None else found for text, found in zip(texts, out, strict=True)]

    def _of_text(self, text: str) -> np.ndarray:
        """The ids of a text that isn't plain, or holds what is white space to Arrow but not to Unicode."""
        if not self.plain(text):
            return Library.ids(self, text)
        return np.frombuffer(b"".join(self._found(self.known, self.pretokens(text), self._encode)), dtype=np.uint32)

    @staticmethod
    def _found(known: dict[str, bytes], pieces: list[str], encode) -> list[bytes]:
        """The ids of each piece, from those that are known or else by ``encode``, which then are known."""
        parts = list(map(known.get, pieces))
        rare = [k for k, part in enumerate(parts) if part is None]
        if rare:
            found = encode([pieces[k] for k in rare])
            for k, part in zip(rare, found, strict=True):
                parts[k] = part
            if len(known) < KNOWN:
                known.update((pieces[k], parts[k]) for k in rare if len(pieces[k]) <= 32)
        return parts

    def _of_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word (lower-cased, without white space), by its pre-tokens."""
        split = list(map(self.split.findall, words))
        parts = iter(self._found(self.known, list(chain.from_iterable(split)), self._encode))
        return [b"".join(islice(parts, len(pretokens))) for pretokens in split]

    def _encode(self, pretokens: list[str]) -> list[bytes]:
        """The ids of each pre-token, all encoded in one call and cut after ids that end a word."""
        found = np.frombuffer(array("I", self.encoding.encode_ordinary(END.join([*pretokens, ""]))), dtype=np.uint32)
        raw = self.id_of[found].tobytes()
        cuts = [0, *((np.flatnonzero(self.ends[found]) + 1) * 4).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def pieces(self, pretokens: list[str]) -> list[int]:
        encode = self.encoding.encode_ordinary
        known = [k for k, p in enumerate(pretokens) if self.plain(p)]
        out = dict(zip(known, (len(encode(pretokens[k] + END)) for k in known), strict=True))
        rest = [k for k in range(len(pretokens)) if k not in out]
        out |= dict(zip(rest, super().pieces([pretokens[k] for k in rest]), strict=True))
        return [out[k] for k in range(len(pretokens))]


@lru_cache(maxsize=2)
def load(path: str) -> Library:
    """The encoder for a tokenizers file; each Python worker loads it once."""
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    model, splitter, normalizer = config["model"], config.get("pre_tokenizer") or {}, config.get("normalizer") or {}
    strict = any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in config.get("added_tokens", []))
    if model.get("type") != "BPE" or strict or model.get("dropout") or model.get("byte_fallback"):
        return Library(path)
    if splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter["add_prefix_space"] and not normalizer:
        return Bytes(path, config)
    parts = splitter.get("pretokenizers", [])
    words = [n.get("type") for n in normalizer.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
    if words and len(parts) == 2 and parts[0].get("pattern") == {"Regex": WORD_PATTERN} and model.get("end_of_word_suffix") == "</w>":
        return Words(path, config)
    return Library(path)
