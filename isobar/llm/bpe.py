"""Byte-pair encoding without a merge loop: longest matches, checked against compatible pairs.

Two neighbouring tokens are compatible if encoding their joined signs gives just the two. A row of
tokens is the exact result of all merges if, and only if, every neighbouring pair is compatible, so
the encoder only has to find such a row. An Aho-Corasick automaton gives the longest token that
begins at each sign. The encoder takes it, or the next shorter one, as long as the pair fits; where
nothing fits it marks the place as no boundary and steps back. A place is marked at most once,
so the work grows with the length of the text, whatever the text. Pairs are judged by undoing the
merges on both sides of the border, latest first, and remembered.

White space never enters a token here, so the distinct words of a slice, between ASCII white space, are cut
into the library's pieces once, all new pieces encoded together and ids joined by position. Decoding goes
through an offset table: the signs of all tokens in one pool and where each begins; a row of ids is a
gather from the pool.

A null or empty text has no tokens; no ids decode to an empty text. Ids outside the vocabulary and
null ids are left out when decoding, as the library does. Rows with equal ids or texts stay separate rows.
Very long texts are whole: a text above a slice's size is a slice of its own. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from isobar.llm.batches import distinct, gather, map_slices, offsets_of, words
from isobar.llm.packing import byte_signs

MEMO = 600_000  # parts a task remembers
SLICE = 2_000_000  # bytes of text that are encoded at once
LONG = 64  # signs from which a part is not remembered
STEP = 1 << 18
# Signs at the end of a word are symbols of their own, written in a private area.
FINAL = 0xE000
BORDER = "\0"  # no symbol: a zero byte is written by another sign
COMPOSED = "\u0300"
# The library's split for lower-cased ASCII and Latin text. Its alternatives and their order.
LATIN_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
ASCII_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)


class Merges:
    """Tokens as strings of one-character symbols, how each is merged, and which pairs are compatible."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        count = max(vocab.values()) + 1
        self.halves: list[tuple[int, int] | None] = [None] * count
        self.joined: dict[tuple[int, int], int] = {}
        last = -1
        for left, right in merges:
            # The suffix ends a word, so a left half never carries it.
            token = vocab[left + right]
            if token <= last or self.halves[token] is not None:
                raise ValueError("merges must make a new token each, in the order of their ids")
            last = token
            self.halves[token] = vocab[left], vocab[right]
            self.joined[vocab[left], vocab[right]] = token
        self.symbols = [""] * count
        for text, token in vocab.items():
            if self.halves[token] is None:
                body = text.removesuffix(suffix) if suffix and len(text) > 1 else text
                if len(body) != 1:
                    raise ValueError(f"neither a sign nor a merge: {text!r}")
                self.symbols[token] = body if body == text else chr(FINAL + ord(body))
        for token, halves in enumerate(self.halves):
            if halves:
                self.symbols[token] = self.symbols[halves[0]] + self.symbols[halves[1]]
        self.sizes = [len(s) for s in self.symbols]
        self.size_array = np.array(self.sizes, np.int64)
        self.pairs: dict[tuple[int, int], bool] = {}
        # A token counts only if merging its own signs gives it back.
        sound: list[bool] = []
        for token, halves in enumerate(self.halves):
            sound.append(halves is None or (sound[halves[0]] and sound[halves[1]] and not self.crossed(*halves, token)))
        self.by_symbols = {s: t for t, s in enumerate(self.symbols) if s and sound[t]}
        self.automaton = ahocorasick.Automaton()
        for s, t in self.by_symbols.items():
            self.automaton.add_word(s, t)
        self.automaton.make_automaton()
        self.prefixes: dict[int, int] = {}

    def crossed(self, left: int, right: int, limit: int | None = None) -> bool:
        """Whether a merge across the border comes before the merges on its two sides.

        Until the merge ``limit`` (None: never) both sides stand as they are. A merge makes the token
        of its own number, so the larger of two tokens was made later, of two equal ones the right one.
        """
        before = len(self.halves) if limit is None else limit
        while True:
            if self.joined.get((left, right), before) < before:
                return True
            made_left, made_right = self.halves[left], self.halves[right]
            if made_left and (not made_right or left > right):
                before, left = left, made_left[1]
            elif made_right:
                # A merge of the same number across the border stands further left and comes first.
                before, right = right + 1, made_right[0]
            else:
                return False

    def compatible(self, left: int, right: int) -> bool:
        pair = left, right
        known = self.pairs.get(pair)
        if known is None:
            known = self.pairs[pair] = not self.crossed(left, right)
        return known

    def shorter(self, token: int) -> int:
        """The longest other token that this one begins with; -1 if there is none."""
        known = self.prefixes.get(token)
        if known is None:
            body = self.symbols[token]
            found = (self.by_symbols.get(body[:k], -1) for k in range(len(body) - 1, 0, -1))
            known = self.prefixes[token] = next((t for t in found if t >= 0), -1)
        return known

    def longest_from(self, text: str) -> list[int]:
        """The longest token that begins at each place."""
        sizes, out = self.sizes, [-1] * len(text)
        for end, token in self.automaton.iter(text):  # ends ascend, so the longest comes last
            out[end + 1 - sizes[token]] = token
        return out

    def encode(self, text: str, begun: list[int] | None = None) -> list[int]:
        """Ids of one run of symbols that merges may join, stepping back where pairs do not fit.

        ``begun`` are longest matches from the start, the last of which may not fit behind the others, which do.
        """
        sizes, pairs, prefixes, n = self.sizes, self.pairs, self.prefixes, len(text)
        longest: list[int] | None = None
        out = list(begun or [])
        closed: set[int] = set()  # places that are no border of the result
        at = 0
        if out:
            token = out.pop()
            at = sum([sizes[t] for t in out])
        else:
            longest = self.longest_from(text)
            token = longest[0] if text else -1
        while at < n:
            if token < 0:
                if not out:
                    raise ValueError(f"no tokens for {text[:40]!r}")
                closed.add(at)
                token = out.pop()
                at -= sizes[token]
            elif at + sizes[token] not in closed:
                fits = True
                if out:
                    pair = out[-1], token
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = not self.crossed(*pair)
                if fits:
                    out.append(token)
                    at += sizes[token]
                    if at < n:
                        if longest is None:
                            longest = self.longest_from(text)
                        token = longest[at]
                    continue
            known = prefixes.get(token)
            token = self.shorter(token) if known is None else known
        return out

    def encode_all(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many runs in a row, and where each begins.

        One pass of the automaton cuts all runs into longest matches. Where a run is covered and all its pairs
        fit, that is the result; the others go through ``encode``.
        """
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        borders = offsets_of(lengths + 1)[:-1]
        found = np.fromiter(chain.from_iterable(self.automaton.iter_long(BORDER.join(runs))), np.int64).reshape(-1, 2)
        ends, tokens = found[:, 0] + 1, found[:, 1]
        starts = ends - self.size_array[tokens]
        own = np.searchsorted(borders, starts, side="right") - 1
        first = np.append(True, own[1:] != own[:-1])[: len(own)]
        fits = np.where(first, starts == borders[own], starts == np.append(0, ends[:-1])[: len(ends)])
        left, right = tokens[:-1][~first[1:]], tokens[1:][~first[1:]]
        pairs, which = np.unique(left * len(self.sizes) + right, return_inverse=True)
        good = np.array([self.compatible(*divmod(p, len(self.sizes))) for p in pairs.tolist()], bool)
        inner = np.flatnonzero(~first)
        fits[inner] &= good[which] if len(pairs) else True
        counts = np.bincount(own, minlength=len(runs))
        whole = np.bincount(own, self.size_array[tokens], len(runs)).astype(np.int64) == lengths
        whole &= np.bincount(own, ~fits, len(runs)) == 0
        again = np.flatnonzero(~whole)
        if not len(again):
            return tokens, offsets_of(counts)
        begin = offsets_of(counts)
        # Up to its first pair that does not fit a run's matches stand.
        wrong = np.flatnonzero(~fits)
        _, at = np.unique(own[wrong], return_index=True)
        stops = dict(zip(own[wrong[at]].tolist(), (wrong[at] + 1).tolist()))
        all_tokens, begins = tokens.tolist(), begin.tolist()
        mended = [self.encode(runs[i], all_tokens[begins[i]:stops[i]] if i in stops else None) for i in again.tolist()]
        sizes = counts.copy()
        sizes[again] = np.fromiter(map(len, mended), np.int64, len(mended))
        out, out_begin = np.empty(int(sizes.sum()), np.int64), offsets_of(sizes)
        out[np.repeat(whole, sizes)] = tokens[np.repeat(whole, counts)]
        out[np.repeat(~whole, sizes)] = np.fromiter(chain.from_iterable(mended), np.int64)
        return out, out_begin


class Encoder:
    """Ids of words and whole texts as the library's tokenizer file defines them."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        with open(tokenizer_file, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model["type"] != "BPE" or model.get("unk_token") or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain byte-level BPE is encoded this way")
        self.merges = Merges(
            model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]],
            model.get("end_of_word_suffix") or "",
        )
        self.suffix = bool(model.get("end_of_word_suffix"))
        library = Tokenizer.from_file(tokenizer_file)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        special = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
        self.special = special
        # Longer ones first: the library takes the longest that stands at a place.
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.signs = byte_signs()
        # Parts and their ids; a special token is a part of its own.
        self.fixed = {t: np.array([i], np.int32).tobytes() for t, i in special.items()}
        self.parts = dict(self.fixed)

    def plain(self, text: str) -> list[str]:
        """The library's pieces of a text without special tokens, in byte signs."""
        if text.isascii():
            pieces = ASCII_PARTS.findall(text.lower())
            return pieces if text.isprintable() else [p.translate(self.signs) for p in pieces]
        if text.isprintable() and max(text) < COMPOSED:
            low = text.lower()
            if max(low) < COMPOSED:  # composed already, lower-cased sign by sign
                return [p if p.isascii() else p.encode().decode("latin-1").translate(self.signs) for p in LATIN_PARTS.findall(low)]
        return [p for p, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))]

    def pieces(self, word: str) -> list[str]:
        if "<" in word and self.special and self.special_split.search(word):
            return [x for p in self.special_split.split(word) if p for x in ([p] if p in self.special else self.plain(p))]
        return self.plain(word)

    def learn(self, parts: list[str]) -> None:
        """Ids of parts that are not known yet."""
        runs = [p[:-1] + chr(FINAL + ord(p[-1])) for p in parts] if self.suffix else parts
        ids, begin = self.merges.encode_all(runs)
        data, begin = ids.astype("<i4").tobytes(), (4 * begin).tolist()
        self.parts.update({p: data[a:b] for p, a, b in zip(parts, begin, begin[1:])})

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text begins."""
        flat, begin = words(texts)
        names, codes = distinct(flat)
        if not names:
            return np.empty(0, np.int32), begin
        cut = [self.pieces(name) for name in names]
        numbers: dict[str, int] = {}
        places = np.array([numbers.setdefault(p, len(numbers)) for c in cut for p in c], np.int64)
        if len(self.parts) > MEMO:
            self.parts = dict(self.fixed)
        if len(self.merges.pairs) > MEMO:
            self.merges.pairs = {}
        new = [p for p in numbers if p not in self.parts]
        if new:
            self.learn(new)
        table = [self.parts[p] for p in numbers]
        for p in new:
            if len(p) >= LONG:
                del self.parts[p]
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        pool = np.frombuffer(b"".join(table), "<i4")
        # From parts to words, from words to texts.
        inside, each = gather(offsets_of(sizes)[:-1], sizes, places)
        word_ends = offsets_of(each)[offsets_of(np.fromiter(map(len, cut), np.int64, len(cut)))]
        pool, word_sizes = pool[inside], np.diff(word_ends)
        inside, each = gather(word_ends[:-1], word_sizes, codes)
        return pool[inside], offsets_of(each)[begin]


class OffsetTable:
    """The tokens' texts in one pool with the offsets where each begins and ends, an Arrow array."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(tokenizer_file)
        if library.decoder is not None:
            raise ValueError("only tokens joined by blanks are decoded this way")
        named = {i: t for t, i in library.get_vocab(with_added_tokens=True).items()}
        self.known = np.array([i in named for i in range(max(named) + 1)])
        self.texts = pa.array([named.get(i, "") for i in range(len(self.known))], pa.string())

    def decode(self, ids: np.ndarray, begin: np.ndarray) -> pa.Array:
        """The text of each row of ids."""
        inside = (ids >= 0) & (ids < len(self.known))
        inside &= self.known[np.where(inside, ids, 0)]
        if not inside.all():
            begin, ids = offsets_of(inside)[begin], ids[inside]
        picked = self.texts.take(pa.array(ids, pa.int32()))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(begin, pa.int32()), picked), " ")


# A worker of Spark's serves many tasks; the tables are the same for all.
@lru_cache(maxsize=2)
def encoder(tokenizer_file: str) -> Encoder:
    return Encoder(tokenizer_file)


@lru_cache(maxsize=2)
def offset_table(tokenizer_file: str) -> OffsetTable:
    return OffsetTable(tokenizer_file)


def id_lists(ids: np.ndarray, begin: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids, pa.int32()))


def encode(
    docs: DataFrame, tokenizer_file: str, text: str = "text", id_column: str = "doc_id", decoded: bool = False
) -> DataFrame:
    """(id, ids array<int>) per row: the exact ids of the whole text, special tokens only where it spells them.

    With ``decoded`` also what the ids decode to, from the same task: one worker instead of two.
    """
    names = [id_column, "ids", *["decoded"] * decoded]

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, begin = encoder(tokenizer_file).encode(part.column(text))
        columns = [part.column(id_column), id_lists(ids, begin)]
        if decoded:
            columns.append(offset_table(tokenizer_file).decode(ids, begin))
        return pa.RecordBatch.from_arrays(columns, names)

    schema = f"`{id_column}` {dict(docs.dtypes)[id_column]}, ids array<int>" + ", decoded string" * decoded
    return map_slices(docs.select(id_column, text), text, run, schema, size=SLICE)


def decode(rows: DataFrame, tokenizer_file: str, ids: str = "ids", id_column: str = "doc_id") -> DataFrame:
    """(id, ids, decoded) per row; special tokens are kept in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = offset_table(tokenizer_file)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes, dtype=np.int64)
            start = 0
            while start < batch.num_rows:  # about four steps of ids at once, or one longer row
                done = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + 4 * STEP, side="right")))
                part = batch.slice(start, stop - start)
                flat = pc.fill_null(part.column(ids).flatten(), -1).to_numpy(zero_copy_only=False)
                texts = table.decode(flat, offsets_of(sizes[start:stop]))
                yield pa.RecordBatch.from_arrays([part.column(id_column), part.column(ids), texts], [id_column, ids, "decoded"])
                start = stop

    kinds = dict(rows.dtypes)
    schema = f"`{id_column}` {kinds[id_column]}, `{ids}` {kinds[ids]}, decoded string"
    return rows.select(id_column, ids).mapInArrow(run, schema)
