"""Token ids of whole texts by the tokenizers library, each distinct unit encoded once.

A text is cut where its pre-tokenizer always cuts: at white space. Units repeat a lot, so
their ids are kept and only new ones go to the library; the ids of a text are those of its
units, which equals encoding the text whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import compress
from operator import add

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

#: White space of the pre-tokenizer's patterns (Unicode White_Space).
_SPACE = "\t-\r \x85\xa0  -     　"
#: A word with the one blank before it; else white space up to the last one before a word.
BYTE_UNIT = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")

#: What stands between white space.
WORD_UNIT = re.compile(f"[^{_SPACE}]+")

#: Marks behind a word of letters. The pre-tokenizer cuts between the two (an apostrophe may
#: begin a contraction, so it is no such mark), which lets units with different marks share
#: the word. No special token is one word and marks behind it.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

#: Units kept in one Python worker before its cache starts anew.
CACHE_UNITS = 600_000

#: Units that go to the library in one text.
JOINED_UNITS = 256


def byte_letters() -> dict[str, int]:
    """Letter of each byte in a byte-level vocabulary: printable bytes are themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


#: From bytes, read as Latin-1, to their letters; a line feed separates words.
_LETTERS = {byte: letter for letter, byte in byte_letters().items()} | {10: " "}


def _end_to_end(table: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all entries, and how many each has."""
    return np.frombuffer(b"".join(table), "<u4"), np.fromiter(map(len, table), np.int32, len(table)) // 4


def _taken(ids: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the entries ``at`` one after the other, and how many each has; 32 bits count what a batch has."""
    lengths = sizes[at]
    begins = (np.cumsum(sizes, dtype=np.int64) - sizes)[at] - (np.cumsum(lengths, dtype=np.int64) - lengths)
    places = np.repeat(begins.astype(np.int32), lengths)
    places += np.arange(len(places), dtype=np.int32)
    return ids.take(places), lengths


def _perhaps_spaced(pieces: pa.Array) -> np.ndarray:
    """Which pieces are empty or have a control character or one beyond ASCII, so perhaps white space."""
    _, offsets, data = pieces.buffers()
    offsets = np.frombuffer(offsets, np.int32)[pieces.offset :][: len(pieces) + 1]
    raw = np.frombuffer(data or b"", np.uint8)
    odd = np.append(0, np.cumsum((raw < 32) | (raw > 127), dtype=np.int64))
    return (offsets[1:] == offsets[:-1]) | (odd[offsets[1:]] > odd[offsets[:-1]])


class Units:
    """Ids of units as little-endian unsigned 32-bit integers, encoded on first sight.

    New units go to the library many in one text, as a call costs more than a unit. A
    separator stands between them: the pre-tokenizer cuts on both sides of it, and it has
    one id that no unit without its character has. Words of Latin letters, nearly all new
    units, are one pre-token each and go to the library's model without the normalizer and
    the pre-tokenizer, which take most of its time.
    """

    #: The separator, and the character that a unit must lack to be joined with others.
    SEPARATOR, MARK = "", ""

    #: End of the tokens that end a word, no part of their spelling.
    WORD_END = ""

    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {token.content: i for i, token in added.items()}
        self.separator = np.array(self.tokenizer.encode(self.SEPARATOR, add_special_tokens=False).ids)
        if len(self.separator) != 1:
            raise ValueError(f"{name} has no single id for the separator")
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        vocab = self.tokenizer.get_vocab()
        self.spelled = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.spelled[i] = len(token.removesuffix(self.WORD_END))
        self.known: dict = {}
        self.forget()

    def forget(self) -> None:
        self.known.clear()
        self.known[""] = b""

    def encode_new(self, units: list[str]) -> list[bytes]:
        """Ids of each unit."""
        letters = [self.of_letters(unit) for unit in units]
        words = iter(self.encode_words(list(compress(units, letters))))
        others = iter(self.encode_others([u for u, is_word in zip(units, letters, strict=True) if not is_word]))
        return [next(words) if is_word else next(others) for is_word in letters]

    @staticmethod
    def of_letters(unit: str) -> bool:
        """Whether a unit is one pre-token of letters up to U+00FF, which normalizing only lowers."""
        return unit.isalpha() and (unit.isascii() or max(unit) <= "\xff")

    @staticmethod
    def normalized(text: str) -> str:
        """Words of letters as the normalizer leaves them."""
        return text

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, by the library's model alone.

        A word's ids are those that spell its bytes, one letter a byte.
        """
        groups = [words[i : i + JOINED_UNITS] for i in range(0, len(words), JOINED_UNITS)]
        spelled = [self.normalized("\n".join(group)).encode() for group in groups]
        joined = [raw.decode("latin-1").translate(_LETTERS) for raw in spelled]
        out: list[bytes] = []
        for group, raw, found in zip(
            groups, spelled, self.model.encode_batch_fast(joined, add_special_tokens=False), strict=True
        ):
            ids = np.array(found.ids, "<u4")
            gaps = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
            stops = np.append(gaps, len(raw)) - np.arange(len(group))
            reached = np.cumsum(self.spelled[ids])
            at = np.searchsorted(reached, stops)
            if len(at) > len(ids) or at[-1] != len(ids) - 1 or (reached[at] != stops).any():
                out += self.encode_others(group)
                continue
            blob, ends = ids.tobytes(), (4 * at + 4).tolist()
            out += [blob[start:end] for start, end in zip([0, *ends], ends)]  # noqa: B905
        return out

    def encode_others(self, units: list[str]) -> list[bytes]:
        """Ids of units of any kind, by the library as a whole."""
        out: list[bytes] = [b""] * len(units)
        plain = [i for i, unit in enumerate(units) if self.MARK not in unit]
        alone = [i for i, unit in enumerate(units) if self.MARK in unit]
        groups = [plain[i : i + JOINED_UNITS] for i in range(0, len(plain), JOINED_UNITS)]
        joined = [self.SEPARATOR.join([units[i] for i in group]) for group in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            at = np.flatnonzero(ids == self.separator[0])
            if len(at) != len(group) - 1:
                alone += group
                continue
            blob = ids.tobytes()
            starts, ends = [0, *(4 * at + 4).tolist()], [*(4 * at).tolist(), len(blob)]
            for i, start, end in zip(group, starts, ends, strict=True):
                out[i] = blob[start:end]
        encoded = self.tokenizer.encode_batch_fast([units[i] for i in alone], add_special_tokens=False)
        for i, found in zip(alone, encoded, strict=True):
            out[i] = np.array(found.ids, "<u4").tobytes()
        return out

    def learn(self, units: set) -> None:
        new = units.difference(self.known)
        if not new:
            return
        if len(self.known) + len(new) > CACHE_UNITS:
            self.forget()
            new = units.difference(self.known)
        listed = list(new)
        # A unit is a word and what follows it, each text of its own that other units share.
        words, rests = self.split(listed)
        alone = list({*words, *rests}.difference(self.known))
        self.known.update(zip(alone, self.encode_new(alone), strict=True))
        ids = self.known.__getitem__
        both = [unit != word for unit, word in zip(listed, words, strict=True)]
        listed, words, rests = (list(compress(part, both)) for part in (listed, words, rests))
        self.known.update(zip(listed, map(add, map(ids, words), map(ids, rests)), strict=True))

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text."""
        cut = [self.units(text) for text in texts]
        self.learn(set().union(*cut))
        ids = self.known.__getitem__
        return [b"".join(map(ids, units)) for units in cut]

    def ids(self, text: str) -> bytes:
        return self.many([text])[0]


class ByteUnits(Units):
    """Byte-level BPE: units keep their blank; special tokens cut the text first."""

    SEPARATOR = MARK = "\n"

    #: Words and marks kept in one Python worker when texts come by the batch; what they make up is not kept.
    CACHE_WORDS = 800_000

    def forget(self) -> None:
        super().forget()
        self.known.update({content: np.array([i], "<u4").tobytes() for content, i in self.special.items()})

    @staticmethod
    def split(units: list[str]) -> tuple[list[str], list[str]]:
        cores = [u.rstrip(MARKS) for u in units]
        words = [c if c[1:].isalpha() else u for c, u in zip(cores, units, strict=True)]
        return words, [u[len(w) :] for w, u in zip(words, units, strict=True)]

    @staticmethod
    def of_letters(unit: str) -> bool:
        return Units.of_letters(unit.removeprefix(" "))

    def encode_others(self, units: list[str]) -> list[bytes]:
        # White space next to the separator would be cut otherwise than alone.
        blank = [unit.isspace() for unit in units]
        words = iter(super().encode_others([u for u, b in zip(units, blank, strict=True) if not b]))
        spaces = self.tokenizer.encode_batch_fast(
            [u for u, b in zip(units, blank, strict=True) if b], add_special_tokens=False
        )
        runs = iter(np.array(found.ids, "<u4").tobytes() for found in spaces)
        return [next(runs) if b else next(words) for b in blank]

    def units(self, text: str) -> list[str]:
        for content in self.special:
            if content in text:
                first, *rest = (self.units(part) for part in text.split(content))
                return first + [u for part in rest for u in (content, *part)]
        return BYTE_UNIT.findall(text)

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts one after the other, and how many each text has; nulls count as empty.

        Arrow cuts at single blanks and finds the distinct pieces. A piece is encoded with the
        blank before it, the first of a text without. Such a cut is one of the pre-tokenizer's
        unless white space stands on both sides of the blank; texts with such a blank are cut
        by the pattern, and so are those with a special token. Where all line feeds of a text
        stand alone between words, it is cut before and behind them too.
        """
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        texts = texts.cast(pa.string()).fill_null("")
        lines = pc.invert(pc.match_substring_regex(texts, r"\n[\n ]| \n|^\n|\n$"))
        cut = pc.split_pattern(pc.if_else(lines, pc.replace_substring(texts, "\n", " \n "), texts), " ")
        bounds = cut.offsets.to_numpy()
        starts, stops = bounds[:-1], bounds[1:]
        coded = cut.flatten().dictionary_encode()
        pieces, at = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        slow = np.flatnonzero(self._between_spaces(pieces, at, starts) | self._with_special(pieces, at, starts))
        feed = pieces.index("\n").as_py()
        feeds = (at == feed) & np.repeat(lines.to_numpy(zero_copy_only=False), stops - starts)
        # Neither first pieces nor such line feeds, nor what follows them, have a blank before them.
        bare = feeds.copy()
        bare[1:] |= feeds[:-1]
        bare[starts] = True
        ids, sizes, known = [], [], 0
        for part, blank in ((~bare, " "), (bare, "")):
            chosen = np.zeros(len(pieces), bool)
            chosen[at[part]] = True
            found = self._of_pieces(pieces.filter(pa.array(chosen)), blank)
            at[part] = (np.cumsum(chosen) + (known - 1))[at[part]]
            ids.append(found[0])
            sizes.append(found[1])
            known += len(found[1])
        # A text cut by the pattern is one piece of its own, and those that it had are empty.
        for text in slow.tolist():
            at[starts[text] : stops[text]] = known + len(slow)
        at[starts[slow]] = known + np.arange(len(slow))
        own, own_sizes = _end_to_end([*self.many(texts.take(pa.array(slow)).to_pylist()), b""])
        all_ids, lengths = _taken(np.concatenate([*ids, own]), np.concatenate([*sizes, own_sizes]), at)
        return all_ids, np.add.reduceat(lengths, starts, dtype=np.int64)

    @staticmethod
    def _between_spaces(pieces: pa.Array, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Texts where a blank stands between white space, given their pieces around blanks."""
        head, tail, empty = np.zeros((3, len(pieces)), bool)
        spaced = np.flatnonzero(_perhaps_spaced(pieces))
        for i, piece in zip(spaced.tolist(), pieces.take(pa.array(spaced)).to_numpy(zero_copy_only=False).tolist(), strict=True):
            head[i], tail[i], empty[i] = not piece or piece[0].isspace(), not piece or piece[-1].isspace(), not piece
        # Nothing stands before an empty first piece, and no piece before the first.
        first, bad = np.zeros(len(at), bool), np.zeros(len(starts), bool)
        first[starts] = True
        later = np.flatnonzero(head[at] & ~first)
        before = at[later - 1]
        later = later[tail[before] & ~(first[later - 1] & empty[before])]
        bad[np.searchsorted(starts, later, side="right") - 1] = True
        return bad

    def _with_special(self, pieces: pa.Array, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Texts that hold a special token, of which none has a blank."""
        marked = np.zeros(len(pieces), bool)
        for content in self.special:
            marked |= pc.match_substring(pieces, content).to_numpy(zero_copy_only=False)
        return np.logical_or.reduceat(marked[at], starts) if marked.any() else np.zeros(len(starts), bool)

    def _of_pieces(self, pieces: pa.Array, blank: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces one after the other, and how many each has.

        Pieces are a word and marks behind it, or else cut by the pattern.
        """
        cores = pc.ascii_rtrim(pieces, MARKS)
        marks = (pc.binary_length(pieces).to_numpy() - pc.binary_length(cores).to_numpy()).astype(np.int64)
        coded = cores.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        is_word = np.fromiter(map(str.isalpha, words), bool, len(words))
        words = [blank + word if alpha else "" for word, alpha in zip(words, is_word.tolist(), strict=True)]
        at = coded.indices.to_numpy().astype(np.int64)
        plain = is_word[at]
        marked, others = np.flatnonzero(plain & (marks > 0)), np.flatnonzero(~plain)
        ends = pieces.take(pa.array(marked)).to_numpy(zero_copy_only=False).tolist()
        ends = [piece[-n:] for piece, n in zip(ends, marks[marked].tolist(), strict=True)]
        cut = [BYTE_UNIT.findall(blank + piece) for piece in pieces.take(pa.array(others)).to_numpy(zero_copy_only=False).tolist()]
        units = list({unit for found in cut for unit in found})
        firsts, seconds = self.split(units)
        self.keep([*words, *ends, *firsts, *seconds])
        ids = self.known.__getitem__
        of_unit = dict(zip(units, map(add, map(ids, firsts), map(ids, seconds)), strict=True))
        of_others = [b"".join([of_unit[unit] for unit in found]) for found in cut]
        # The last is empty: what stands behind most words.
        table = [*map(ids, words), *map(ids, ends), *of_others, b""]
        both = np.full((len(pieces), 2), len(table) - 1)
        both[:, 0] = at
        both[marked, 1] = len(words) + np.arange(len(marked))
        both[others, 1] = len(words) + len(marked) + np.arange(len(others))
        all_ids, lengths = _taken(*_end_to_end(table), both.ravel())
        return all_ids, lengths.reshape(-1, 2).sum(axis=1, dtype=np.int32)

    def keep(self, units: list[str]) -> None:
        """Encode what is not known yet; if that gets too much, only what is asked for stays."""
        new = list({unit for unit in units if unit not in self.known})
        if len(self.known) + len(new) > self.CACHE_WORDS:
            kept = {unit: self.known[unit] for unit in units if unit in self.known}
            self.forget()
            self.known.update(kept)
        self.known.update(zip(new, self.encode_new(new), strict=True))


class WordUnits(Units):
    """BPE with word ends: white space is dropped, so any white space separates units."""

    SEPARATOR, MARK, WORD_END = " | ", "|", "</w>"

    @staticmethod
    def normalized(text: str) -> str:
        return text.lower()

    @staticmethod
    def split(units: list[str]) -> tuple[list[str], list[str]]:
        cores = [u.rstrip(MARKS) for u in units]
        # The normalizer lowers letters one by one, so capitals share the word; the length of
        # a word in Latin letters stays the same.
        words = [
            c.lower() if c.isalpha() and (c.isascii() or max(c) <= "\xff") else u
            for c, u in zip(cores, units, strict=True)
        ]
        return words, [u[len(w) :] for w, u in zip(words, units, strict=True)]

    @staticmethod
    def units(text: str) -> list[str]:
        # Python takes four control characters for white space that the tokenizer does not.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return WORD_UNIT.findall(text)
        return text.split()


_CLASSES = {"byte_bpe_50k.json": ByteUnits, "word_bpe_49k.json": WordUnits}


@lru_cache(4)
def encoder(name: str) -> Units:
    """The encoder of a public tokenizer file, one in each Python worker."""
    return _CLASSES[name](name)
