"""Token ids of whole texts by a public byte-level BPE vocabulary of the ``tokenizers`` library."""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "byte_bpe_50k.json"
CACHE_WORDS = 300_000
CACHE_CHARS = 40
CLOSING = ".,;:!?"
JOINED_WORDS = 1_000

# Where white space runs this long or ends the text, a cut before a space could part a run that the vocabulary reads whole.
_LONG_BLANK = re.compile(r"\s(?:(?<=[\x1c-\x1f])|\s(?:\s|\Z))")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file; a path is taken as it is."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _joined(ids: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the entries ``codes`` in a row and how many each has; ``ids`` holds all entries in a row."""
    starts, taken = np.cumsum(sizes) - sizes, sizes[codes]
    ends = np.cumsum(taken)
    place = np.repeat(starts[codes] - (ends - taken), taken)
    return ids[place + np.arange(len(place))], taken


class KnownWords:
    """Words and their ids as arrays. Above the limit those that were asked for last stay, half of the limit."""

    def __init__(self) -> None:
        self.words, self.ids = pa.array([], pa.large_string()), np.zeros(0, dtype=np.uint32)
        self.sizes, self.asked, self.turn = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 0

    def __iter__(self):
        return iter(self.words.to_pylist())

    def find(self, words: pa.Array) -> np.ndarray:
        """The place of each word, -1 for new ones."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        self.turn += 1
        self.asked[at[at >= 0]] = self.turn
        return at

    def add(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        self.asked = np.concatenate([self.asked, np.full(len(words), self.turn)])
        if len(self.words) > CACHE_WORDS:
            kept = np.sort(np.argsort(self.asked, kind="stable")[-(CACHE_WORDS // 2):])
            self.words, self.asked = self.words.take(pa.array(kept)), self.asked[kept]
            self.ids, self.sizes = _joined(self.ids, self.sizes, kept)


class TextEncoder:
    """Ids of texts. Pieces cut at single spaces are numbered, encoded once and remembered.

    The vocabulary never merges over the start of a word with its leading space, so the ids of the
    pieces in a row are the ids of the text. Texts with long white space, and those that hold the text of an added token,
    are encoded whole by the library. New pieces are encoded many at once, joined by what comes before them, a space or a line
    feed: as their first ids alone begin with it, these tell the pieces apart again. Closing punctuation after letters is a
    unit of its own in the vocabulary's split, and so is a single line feed between two words.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        spec = whole["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["merges"]]
        self.tokenizer = Tokenizer.from_file(path)
        # Pieces are remembered here, so the library's own cache of single words only costs time.
        self.tokenizer.model = models.BPE(vocab=spec["vocab"], merges=merges, cache_capacity=0)
        self.marks = [t["content"] for t in whole.get("added_tokens") or []]
        self.size = max(spec["vocab"].values()) + 1
        # How byte-level vocabularies of this kind spell a space and a line feed.
        self.opens = {}
        for gap, spelled in ((" ", "\u0120"), ("\n", "\u010a")):
            self.opens[gap] = np.zeros(self.size, dtype=bool)
            self.opens[gap][[i for token, i in spec["vocab"].items() if token.startswith(spelled)]] = True
        self.joins = not any(c.isspace() for m in self.marks for c in m)
        self.after = {" ": KnownWords(), "\n": KnownWords()}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def _all_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self._ids(t) for t in texts]
        return np.concatenate([np.zeros(0, dtype=np.uint32), *found]), np.array([len(f) for f in found], dtype=np.int64)

    def _learn(self, words: list[str], gap: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``gap + word`` in a row and how many each has."""
        ids, sizes = [], []
        for at in range(0, len(words), JOINED_WORDS):
            part = words[at:at + JOINED_WORDS]
            found = self._ids(gap + gap.join(part)) if self.joins and "" not in part else np.zeros(0, dtype=np.uint32)
            cuts = np.flatnonzero(self.opens[gap][found])
            if len(cuts) == len(part):
                number = np.diff(cuts, append=len(found))
            else:
                found, number = self._all_ids([gap + w for w in part])
            ids.append(found)
            sizes.append(number)
        return np.concatenate(ids), np.concatenate(sizes)

    def _ids_of(self, words: pa.Array, gap: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``gap + word`` in a row and how many each has.

        The words have no white space at their ends, and none inside if the gap is a line feed.
        """
        known = self.after[gap]
        cores = pc.utf8_rtrim(words, characters=CLOSING)
        marks = pc.subtract(pc.utf8_length(words), pc.utf8_length(cores)).to_numpy()
        # The library may know fewer letters than Arrow does, but not of the Latin ones.
        latin = pc.less(pc.utf8_slice_codeunits(cores, -1, None), pa.scalar("ɐ", pa.large_string()))
        closed = (marks > 0) & (marks <= 4) & pc.and_(pc.utf8_is_alpha(cores), latin).to_numpy(zero_copy_only=False)
        stems = pc.if_else(pa.array(closed), cores, words).dictionary_encode()
        asked, ids, sizes = stems.dictionary, known.ids, known.sizes
        at = known.find(asked)
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = len(sizes) + np.arange(len(new))
            fresh = asked.take(pa.array(new))
            found, number = self._learn(fresh.to_pylist(), gap)
            ids, sizes = np.concatenate([ids, found]), np.concatenate([sizes, number])
            kept = np.flatnonzero(pc.utf8_length(fresh).to_numpy() <= CACHE_CHARS)
            known.add(fresh.take(pa.array(kept)), *_joined(found, number, kept))
        # Each word is its stem and its closing marks; the last entry stands for none.
        ends = [w[-n:] for w, n in zip(words.filter(pa.array(closed)).to_pylist(), marks[closed].tolist())]
        place = {end: k for k, end in enumerate(dict.fromkeys(ends))}
        found, number = self._all_ids(list(place))
        codes = np.full((len(words), 2), len(sizes) + len(number))
        codes[:, 0] = at[stems.indices.to_numpy()]
        codes[closed, 1] = len(sizes) + np.array([place[e] for e in ends], dtype=np.int64)
        ids, taken = _joined(np.concatenate([ids, found]), np.concatenate([sizes, number, [0]]), codes.ravel())
        return ids, taken.reshape(-1, 2).sum(axis=1)

    def _spaced_and_first(self, words: pa.Array, first: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a space and each of the words, then of the first words of texts, which no space comes before."""
        length = pc.utf8_length(words)
        blank = pc.or_(pc.match_substring(words, "\n"), pc.less(pc.utf8_length(pc.utf8_trim_whitespace(words)), length))
        special = pc.or_(blank, pc.equal(length, 0)).to_numpy(zero_copy_only=False)
        usual, odd = np.flatnonzero(~special), np.flatnonzero(special)
        count = np.ones(len(words), dtype=np.int64)
        # Words with line feeds are cut there: heads follow the space, lines a line feed.
        heads, lines, alone, owners, broken = [], [], [], [], []
        for k, word in zip(odd.tolist(), words.take(pa.array(odd)).to_pylist()):
            pieces = word.split("\n")
            if len(pieces) > 1 and word.split() == pieces:
                broken.append(k)
                heads.append(pieces[0])
                lines += pieces[1:]
                count[k] = len(pieces)
            elif not word or word[0].isspace() or word[-1].isspace():
                owners.append(k)
                alone.append(" " + word)
            else:
                broken.append(k)
                heads.append(word)
        # A text's first word is known after a line feed, whose id is cut off; one with white space is left to the library.
        plain = [bool(w) and w.split() == [w] for w in first]
        spaced = self._ids_of(pa.concat_arrays([words.take(pa.array(usual)), pa.array(heads, pa.large_string())]), " ")
        lined = self._ids_of(pa.array(lines + [w for w, p in zip(first, plain) if p], pa.large_string()), "\n")
        other = self._all_ids(alone + [w for w, p in zip(first, plain) if not p])
        ids, sizes = (np.concatenate(x) for x in zip(spaced, lined, other))
        rest = len(spaced[1]) + len(lined[1])
        opening = np.arange(len(spaced[1]) + len(lines), rest)
        ids = np.delete(ids, (np.cumsum(sizes) - sizes)[opening])
        sizes[opening] -= 1
        starts = np.cumsum(count) - count
        units = np.full(int(count.sum()), -1)
        units[starts[usual]] = np.arange(len(usual))
        units[starts[owners]] = rest + np.arange(len(owners))
        units[starts[broken]] = len(usual) + np.arange(len(broken))
        units[units < 0] = len(spaced[1]) + np.arange(len(lines))
        firsts, flags = np.empty(len(first), dtype=np.int64), np.array(plain, dtype=bool)
        firsts[flags], firsts[~flags] = opening, rest + len(owners) + np.arange(len(first) - len(opening))
        ids, taken = _joined(ids, sizes, np.concatenate([units, firsts]))
        return ids, np.add.reduceat(taken, np.concatenate([starts, len(units) + np.arange(len(first))]))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One array of unsigned 32-bit ids per text."""
        whole = [bool(_LONG_BLANK.search(t)) or any(m in t for m in self.marks) for t in texts]
        out = [self._ids(t) if w else None for t, w in zip(texts, whole)]
        cut = [k for k, w in enumerate(whole) if not w]
        if not cut:
            return out
        split = pc.split_pattern(pa.array([texts[k] for k in cut], pa.large_string()), " ")
        words = split.values.dictionary_encode()
        codes, places = words.indices.to_numpy().astype(np.int64), split.offsets.to_numpy()
        starts = places[:-1]
        first = words.dictionary.take(words.indices.take(pa.array(starts))).to_pylist()
        ids, sizes = self._spaced_and_first(words.dictionary, first)
        codes[starts] = len(words.dictionary) + np.arange(len(cut))
        ids, taken = _joined(ids, sizes, codes)
        ends = np.concatenate([[0], np.cumsum(taken)])[places].tolist()
        for k, a, b in zip(cut, ends, ends[1:]):
            out[k] = ids[a:b]
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """The encoder of a vocabulary file, kept for the tasks that the same Python worker runs."""
    return TextEncoder(path)
