"""Byte-pair encoding by speculation: greedy proposals, vectorised verification, exact repair.

Each distinct word of a block of texts is cut greedily into the longest tokens. Such a cut is
the byte-pair encoding exactly if every token encodes to itself and every adjacent pair of
tokens does, since a merge across a border involves only the pieces next to it. Merges in
order of rank build both tokens of a pair bottom-up, so the pieces at the border follow from
the right spine of one and the left spine of the other; :meth:`Tables.compatible` walks these
spines for all pairs at once and looks for a merge that would have come first. Words with a
failing pair are merged exactly with a heap.

The vocabulary file is read on the driver and travels with the tasks (a few MB, fixed).
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from locusloom.llm import bytesops
from locusloom.llm.tables import text_rows

NEVER = 1 << 30
SECTION = 1 << 21
#: Words whose ids a worker remembers: about 40 MB.
CACHE_WORDS = 1 << 17
SPACE, LETTER, DIGIT, OTHER = range(4)
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")  # fixed values of the tokenizer's pattern


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    letters = dict(zip(plain, map(chr, plain))) | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Tables:
    """Arrays over the vocabulary: symbols, merges, spines and tokens by their symbols."""

    def __init__(self, definition: str):
        model = json.loads(definition)
        known, suffix = model["model"]["vocab"], model["model"]["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        size = max([*known.values(), *self.special.values()]) + 1
        self.strings = np.full(size, "", object)
        for text, number in [*known.items(), *self.special.items()]:
            self.strings[number] = text
        letters = byte_letters()
        self.inner = np.array([known[x] for x in letters])
        self.final = np.array([known[x + suffix] for x in letters])
        self.left, self.right = np.arange(size), np.arange(size)
        self.born = np.full(size, -1)
        keys = np.empty(len(pairs), np.int64)
        self.stride = size
        self.merged = np.empty(len(pairs), np.int64)
        for rank, (a, b) in enumerate(pairs):
            t = known[a + b]
            self.left[t], self.right[t], self.born[t] = known[a], known[b], rank
            keys[rank], self.merged[rank] = known[a] * size + known[b], t
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        made = np.flatnonzero(self.born >= 0)
        sound = np.ones(size, bool)
        sound[made] = self.compatible(self.left[made], self.right[made], self.born[made])
        while True:  # a token encodes to itself if its halves do
            fewer = sound & sound[self.left] & sound[self.right]
            if (fewer == sound).all():
                break
            sound = fewer
        self.sound = sound
        self._by_length(made)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.stride + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses the border of ``a b`` (before rank ``until``).

        A piece lives from the rank that made it to the rank that takes it up. Going back in
        time, the younger of the two pieces at the border is undone (of equal ranks the right
        one, as merges go from the left). A crossing merge wins if it ranks before the left
        piece's end, and not after the right piece's.
        """
        good, active = np.ones(len(a), bool), np.arange(len(a))
        x, y = a.copy(), b.copy()
        end_x = np.full(len(a), NEVER) if until is None else until.copy()
        end_y = end_x.copy()
        while len(active):
            m = self.rank(x, y)
            crossed = (m < end_x) & (m <= end_y)
            good[active[crossed]] = False
            bx, by = self.born[x], self.born[y]
            go = ~crossed & ((bx >= 0) | (by >= 0))
            back_x = go & (bx > by)
            back_y = go & ~back_x
            end_x, end_y = np.where(back_x, bx, end_x), np.where(back_y, by, end_y)
            x, y = np.where(back_x, self.right[x], x), np.where(back_y, self.left[y], y)
            active, x, y, end_x, end_y = active[go], x[go], y[go], end_x[go], end_y[go]
        return good

    def _by_length(self, made: np.ndarray) -> None:
        """Hashes of the symbols of each merged token, sorted, by their number."""
        self.pieces: dict[int, list[int]] = {}
        for t in made[np.argsort(self.born[made])].tolist():
            a, b = int(self.left[t]), int(self.right[t])
            self.pieces[t] = self.pieces.get(a, [a]) + self.pieces.get(b, [b])
        flat = np.array([s for t in self.pieces for s in self.pieces[t]])
        size = np.array([len(s) for s in self.pieces.values()])
        ends = np.cumsum(size)
        hashed, tokens = bytesops.Prefix(flat, self.codes()).hashes(ends - size, ends), np.array(list(self.pieces))
        self.pieces = {}
        self.lengths = {}
        for n in sorted(set(size.tolist()), reverse=True):
            own = np.flatnonzero(size == n)
            own = own[np.argsort(hashed[own])]
            self.lengths[n] = (hashed[own], tokens[own])

    def codes(self) -> np.ndarray:
        return bytesops.mix(np.arange(1, self.stride + 1, dtype=np.uint64))

    def propose(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest tokens of each word: (word number, token), in order within a word."""
        prefix = bytesops.Prefix(symbols, self.codes())
        words, at, rounds = np.arange(len(starts)), starts.copy(), []
        while len(words):
            token, step = symbols[at], np.ones(len(at), np.int64)
            todo = np.arange(len(at))
            for n, (hashed, tokens) in self.lengths.items():
                fits = todo[at[todo] + n <= ends[words[todo]]]
                if not len(fits):
                    continue
                h = prefix.hashes(at[fits], at[fits] + n)
                place = np.minimum(np.searchsorted(hashed, h), len(hashed) - 1)
                hit = hashed[place] == h
                token[fits[hit]], step[fits[hit]] = tokens[place[hit]], n
                left = np.ones(len(at), bool)
                left[fits[hit]] = False
                todo = todo[left[todo]]
            rounds.append((words, token))
            at = at + step
            go = at < ends[words]
            words, at = words[go], at[go]
        owner, tokens = np.concatenate([r[0] for r in rounds]), np.concatenate([r[1] for r in rounds])
        order = np.argsort(owner, kind="stable")
        return owner[order], tokens[order]

    def merge(self, symbols: list[int]) -> list[int]:
        """Exact encoding of one word: the merge of lowest rank, leftmost first, until none is left."""
        token, after, before = list(symbols), list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        table = self.pair_table()
        heap = [(r, i, token[i], token[i + 1]) for i in range(len(token) - 1) if (r := table.get((token[i], token[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if token[i] != a or j >= len(token) or token[j] != b:
                continue
            token[i], token[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[i] < len(token):
                before[after[i]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q < len(token) and (r := table.get((token[p], token[q]))) is not None:
                    heapq.heappush(heap, (r, p, token[p], token[q]))
        return [t for t in token if t >= 0]

    def merge_short(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Exact encodings of many short words, one merge of every word at a time."""
        count, most = len(starts), int((ends - starts).max())
        column = np.arange(most)
        token = np.where(column < (ends - starts)[:, None], symbols[np.minimum(starts[:, None] + column, len(symbols) - 1)], -1)
        size = ends - starts
        rank = np.full((count, most), NEVER)
        inside = column[1:] < size[:, None]
        rank[:, :-1][inside] = self.rank(token[:, :-1][inside], token[:, 1:][inside])
        out: list[np.ndarray] = [token[0]] * count
        words = np.arange(count)
        while len(words):
            at = rank.argmin(axis=1)
            row = np.arange(len(words))
            best = rank[row, at]
            for i in np.flatnonzero(best == NEVER):
                out[words[i]] = token[i, : size[i]].copy()
            go = best < NEVER
            words, token, rank, size, at, best = words[go], token[go], rank[go], size[go] - 1, at[go], best[go]
            if not len(words):
                break
            row = np.arange(len(words))
            beyond = np.minimum(column + (column > at[:, None]), most - 1)
            token, rank = np.take_along_axis(token, beyond, 1), np.take_along_axis(rank, np.minimum(beyond, most - 1), 1)
            token[row, at] = self.merged[best]
            rank[row, size - 1] = NEVER
            for i in (at - 1, at):
                near = row[(i >= 0) & (i + 1 < size)]
                rank[near, i[near]] = self.rank(token[near, i[near]], token[near, i[near] + 1])
        return out

    def pair_table(self) -> dict[tuple[int, int], int]:
        if not hasattr(self, "_pairs"):
            a, b = np.divmod(self.keys, self.stride)
            self._pairs = dict(zip(zip(a.tolist(), b.tolist()), self.ranks.tolist()))
        return self._pairs

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Token ids of each word of the pre-tokenizer."""
        raw = [w.encode("utf-8") for w in words]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(r) for r in raw])
        starts = np.concatenate(([0], ends[:-1]))
        symbols = self.inner[data]
        symbols[ends - 1] = self.final[data[ends - 1]]
        owner, tokens = self.propose(symbols, starts, ends)
        wrong = np.zeros(len(words), bool)
        wrong[owner[~self.sound[tokens]]] = True
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        wrong[owner[inside[~self.compatible(tokens[inside], tokens[inside + 1])]]] = True
        firsts = np.searchsorted(owner, np.arange(len(words) + 1))
        found = [tokens[firsts[i] : firsts[i + 1]] for i in range(len(words))]
        size = ends - starts
        for low, high in ((0, 8), (8, 16), (16, 32)):
            some = np.flatnonzero(wrong & (size > low) & (size <= high))
            if len(some):
                for i, tokens in zip(some, self.merge_short(symbols, starts[some], ends[some])):
                    found[i] = tokens
        for i in np.flatnonzero(wrong & (size > 32)):
            found[i] = np.array(self.merge(symbols[starts[i] : ends[i]].tolist()))
        return found


def classes() -> np.ndarray:
    """Class of each code point for the tokenizer's pattern: white space, letter, number or other."""
    cache = bytesops.process_cache()
    if "classes" not in cache:
        every = "".join(map(chr, [*range(0xD800), 0xFFFF, *range(0xE000, 0x110000)]))  # no run goes over the gap of surrogates
        table = np.full(0x110000, OTHER, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+")):
            for m in regex.finditer(pattern, every):
                table[ord(every[m.start()]) : ord(every[m.end() - 1]) + 1] = kind
        table[[9, 10, 11, 12, 13, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
        cache["classes"] = table
    return cache["classes"]


def normalized(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case by single characters
    return text.lower()


def sections(text: str, special: list[str]) -> Iterator[str]:
    """Special tokens, and between them normalised text of bounded length, cut at white space."""
    parts = [text]
    if any(s in text for s in special):
        parts = regex.split("(" + "|".join(map(regex.escape, special)) + ")", text)
    for part in parts:
        if part in special:
            yield part
            continue
        low = 0
        while low < len(part):
            high = len(part)
            if high - low > SECTION:
                high = max(part.rfind(" ", low, low + SECTION), part.rfind("\n", low, low + SECTION)) + 1
                if high <= low:
                    at = regex.search(r"[ \n]", part, pos=low + SECTION)
                    high = at.end() if at else len(part)
            yield normalized(part[low:high])
            low = high


def word_places(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of the pattern in an array of code points."""
    kind = classes()[points]
    n = len(points)
    start = kind != SPACE
    start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    # a run of other characters that starts with an apostrophe may start a contraction
    mark = np.flatnonzero(start & (points == ord("'")))
    if len(mark):
        padded = np.concatenate((points, [0, 0]))
        length = np.zeros(len(mark), np.int64)
        for c in CONTRACTIONS:
            same = np.logical_and.reduce([padded[np.minimum(mark + 1 + j, n)] == ord(x) for j, x in enumerate(c)])
            length = np.where((length == 0) & same, len(c), length)
        mark, length = mark[length > 0], length[length > 0]
        start[mark + 1] = False
        after = mark + 1 + length
        after = after[after < n]
        start[after] |= kind[after] != SPACE
    starts = np.flatnonzero(start)
    stops = np.flatnonzero(kind == SPACE)
    following = np.append(starts[1:], n)
    space = np.append(stops, n)[np.searchsorted(stops, starts)]
    return starts, np.minimum(following, space)


def _round_trip(definition: str):
    def encode_block(tables: Tables, cache: dict[str, np.ndarray], texts: list[str]) -> list[np.ndarray]:
        """Ids of each section; sections are joined by white space, which no word holds."""
        joined = "\n".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts, ends = word_places(points)
        if not len(starts):
            return [np.zeros(0, np.uint32)] * len(texts)
        codes = bytesops.mix(np.arange(int(points.max()) + 1, dtype=np.uint64) + np.uint64(1))
        hashed = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + bytesops.SEGMENT, "right")))
            low = int(starts[i])
            hashed[i:j] = bytesops.Prefix(points[low : ends[j - 1]], codes).hashes(starts[i:j] - low, ends[i:j] - low)
            i = j
        _, first, which = np.unique(hashed, return_index=True, return_inverse=True)
        words = [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        fresh = [w for w in words if w not in cache]
        if len(cache) + len(fresh) > CACHE_WORDS:
            cache.clear()
            fresh = words
        if fresh:
            cache.update(zip(fresh, tables.encode_words(fresh)))
        found = [cache[w] for w in words]
        size = np.array([len(f) for f in found])
        flat = np.concatenate(found).astype(np.uint32)
        begin, own = (np.cumsum(size) - size)[which], size[which]
        total = np.cumsum(own)
        ids = flat[np.repeat(begin - (total - own), own) + np.arange(int(total[-1]))]
        lengths = np.array([len(t) + 1 for t in texts])
        upto = np.concatenate(([0], total))[np.searchsorted(starts, np.cumsum(lengths))]
        return np.split(ids, upto[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = bytesops.process_cache()
        key = ("bpe", hash(definition))
        if key not in shared:
            shared[key] = (Tables(definition), {})
        tables, cache = shared[key]
        special = list(tables.special)
        for whole in batches:
            for batch in bytesops.pieces(whole, "text", SECTION):
                ids: list[list[np.ndarray]] = [[] for _ in range(len(batch))]
                waiting: list[tuple[int, str]] = []

                def flush():
                    if waiting:
                        for (i, _), found in zip(waiting, encode_block(tables, cache, [t for _, t in waiting])):
                            ids[i].append(found)
                        waiting.clear()

                for i, text in enumerate(batch.column("text").to_pylist()):
                    for part in sections(text, special):
                        if part in tables.special:
                            flush()
                            ids[i].append(np.array([tables.special[part]], np.uint32))
                        else:
                            waiting.append((i, part))
                            if len(part) > SECTION // 2:
                                flush()
                flush()
                encoded = [np.concatenate(x) if x else np.zeros(0, np.uint32) for x in ids]
                decoded = [" ".join(tables.strings[x].tolist()) for x in encoded]  # without a decoder, tokens are joined by spaces
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([len(x) for x in encoded], pa.int64()),
                        pa.array([x.astype("<u4").tobytes() for x in encoded], pa.binary()),
                        pa.array(decoded, pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    return run


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)``: every text encoded, and its ids decoded again.

    ``ids`` are little-endian unsigned 32-bit integers as binary. The tokenizer file is one of
    the tokenizers library: byte-pair merges over byte-level letters with an end-of-word
    suffix, after NFC and lower case; without a decoder its tokens are joined by spaces.
    Special tokens in a text become their ids.

    Null and empty texts have no tokens and decode to an empty text; a null ``doc_id`` is kept;
    repeated rows give repeated results; other columns are ignored. Very long texts go in
    sections cut at white space; an unbroken word is encoded whole.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    return text_rows(docs).mapInArrow(_round_trip(definition), "doc_id long, n_tokens long, ids binary, decoded string")
