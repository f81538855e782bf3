"""SentencePiece encoding and decoding as a max-plus scan.

The best segmentation of a text is a longest path over its places. The state at a place is how far a piece reaches
beyond it and, for merge-based (BPE) models, which piece that is: a segmentation is the one that the merges give exactly
when every two neighbouring pieces, encoded alone, stay those two pieces. So unigram models add up piece scores, and BPE
models add 0 for allowed neighbours and minus infinity for others; both are max-plus products of transfer matrices.

Ordinary texts fall into units that no piece crosses (mostly words), each a product with a single state at either end,
kept in a bounded cache; short units of a merge-based model are merged, which gives the one path that is allowed. Giant texts are cut into chunks anywhere. Each chunk yields the transfer matrix from the states
at its start to those at its end; the matrices of a text are combined in order, the best states are traced back from
chunk to chunk, and every chunk is then traced on its own.

The model file is read on the driver and its bytes are sent along. Null and empty texts have no pieces. Characters
without a piece become bytes, or the unknown piece. Repeated rows get equal results. Of several segmentations with the
same score a unigram model gives one with the longest last piece; in a giant text, one of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType
from sentencepiece import sentencepiece_model_pb2

from . import anchors
from .common import BYTE_VALUES, blocks, prefix_hash, span_hash, stored, text_buffer

SPACE = "▁"
#: Key of a state after which any piece may follow: a unit's start, or a character without a piece.
FREE = -1
NEVER = float("inf")
#: Longest unit that is merged pair by pair, which takes a time that grows with its square; longer ones are scanned.
MERGED_CHARS = 64
CACHED_UNITS = 120_000
#: Units of the table by hash, some 30 bytes each.
CACHED_HASHES = 600_000
CACHED_PAIRS = 300_000
State = tuple[int, int]
Transfer = dict[State, dict[State, float]]


class UnitTable:
    """The ids of units by the hash of their bytes: arrays, so that very many take little memory."""

    def __init__(self) -> None:
        self.hashes, self.start, self.size, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def add(self, hashes: np.ndarray, packed: list[bytes]) -> None:
        size = np.array([len(p) // 4 for p in packed], np.int64)
        start = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(packed), np.int32)])
        order = np.argsort(np.concatenate([self.hashes, hashes]), kind="stable")
        for name, more in (("hashes", hashes), ("start", start), ("size", size)):
            setattr(self, name, np.concatenate([getattr(self, name), more])[order])


class Pieces:
    """A SentencePiece model of type unigram or BPE without text normalisation, from the bytes of its file."""

    def __init__(self, data: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        if proto.normalizer_spec.precompiled_charsmap or not proto.normalizer_spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that leave characters as they are and mark white space in front of words")
        if proto.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models")
        kinds = {p.type for p in proto.pieces}
        if 4 in kinds:
            raise ValueError("user-defined symbols are not supported")
        self.bpe = proto.trainer_spec.model_type == 2
        self.prefix, self.squeeze = proto.normalizer_spec.add_dummy_prefix, proto.normalizer_spec.remove_extra_whitespaces
        self.names = [p.piece for p in proto.pieces]
        # to 20 binary places, so that sums are exact and equal in any order
        self.scores = [round(p.score * 2**20) / 2**20 for p in proto.pieces]
        self.vocab = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        self.costs = {p.piece: -s for p, s in zip(proto.pieces, self.scores, strict=True) if p.type == 1}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == 2)
        self.bytes = [i for i, p in enumerate(proto.pieces) if p.type == 6]
        self.hidden = {i for i, p in enumerate(proto.pieces) if p.type in (2, 3)}
        self.longest = max(map(len, self.vocab), default=1)
        self.unknown_score = min((self.scores[i] for i in self.vocab.values()), default=0.0) - 10
        #: What a longer piece may start with.
        self.starts = {p[:i] for p in self.vocab for i in range(1, len(p))}
        chars = {c for p in self.vocab for c in p}
        self.units = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if "\n" not in chars else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        #: Whether units are spaces and what follows them, and whether a line feed is a unit.
        self.words, self.lines = True, "\n" not in chars
        self.table = UnitTable()
        if any(SPACE in p.lstrip(SPACE) for p in self.vocab):
            self.words = False
            self.units = re.compile(r"(?s).+")
        self.allowed: dict[tuple[int, int], bool] = {}
        #: Ids of whole units as packed 32-bit numbers, and for unigram models their scores.
        self.cache: dict[str, bytes] = {}
        self.unit_scores: dict[str, float] = {}
        self._spelling: tuple[np.ndarray, np.ndarray] | None = None
        self._pairs: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None = None

    def normal(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return (" " + text if self.prefix and text else text).replace(" ", SPACE)

    def merged(self, text: str) -> list[str]:
        """The pieces that merging gives: always the best scored pair, the leftmost of equals."""
        parts, cost = list(text), self.costs.get
        # what merging each part with the next one costs
        pairs = [cost(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            best = min(pairs)
            if best == NEVER:
                break
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = cost(parts[at - 1] + parts[at], NEVER)
            if at < len(pairs):
                pairs[at] = cost(parts[at] + parts[at + 1], NEVER)
        return parts

    def may_follow(self, key: int, piece: int) -> bool:
        known = self.allowed.get((key, piece))
        if known is None:
            want = [self.names[piece]] if key == FREE else [self.names[key], self.names[piece]]
            if len(self.allowed) >= CACHED_PAIRS:
                self.allowed.clear()
            known = self.allowed[key, piece] = self.merged("".join(want)) == want
        return known

    def sweep(self, text: str, entries: dict[State, float], begin: int, stop: int, limit: int) -> list[dict[int, tuple[float, int, int, int]]]:
        """Longest paths inside one unit from the states ``entries`` at ``begin`` to all places up to ``limit``.

        Steps start before ``stop``. For each place after ``begin``: key -> (score, place before, key before, piece).
        """
        nodes: list[dict[int, tuple[float, int, int, int]]] = [{} for _ in range(limit - begin + 1)]
        for (reach, key), score in entries.items():
            if reach <= limit - begin:
                nodes[reach][key] = (score, -1, FREE, -1)
        for at in range(begin, stop):
            here = nodes[at - begin]
            if not here:
                continue
            for end in range(at + 1, min(at + self.longest, limit) + 1):
                part = text[at:end]
                piece = self.vocab.get(part)
                gain = 0.0
                if piece is None:
                    if end > at + 1:
                        if part not in self.starts:
                            break
                        continue
                    piece, new, gain = self.unknown, FREE, 0.0 if self.bpe else self.unknown_score
                elif self.bpe:
                    new = piece
                else:
                    new, gain = FREE, self.scores[piece]
                target = nodes[end - begin]
                for key, (score, *_) in here.items():
                    if self.bpe and new != FREE and not self.may_follow(key, piece):
                        continue
                    if new not in target or score + gain > target[new][0]:
                        target[new] = (score + gain, at, key, piece)
        return nodes

    @staticmethod
    def trace(nodes: list[dict[int, tuple[float, int, int, int]]], begin: int, state: State) -> list[tuple[int, int]]:
        """(piece, place) of the steps to ``state`` (place from ``begin``, key), in order."""
        at, key = state
        out = []
        while True:
            _, before, old, piece = nodes[at][key]
            if piece < 0:
                return out[::-1]
            out.append((piece, before))
            at, key = before - begin, old

    def spelled(self, text: str, steps: list[tuple[int, int]]) -> list[int]:
        """Piece ids, characters without a piece as bytes."""
        out: list[int] = []
        for piece, at in steps:
            if piece == self.unknown and len(self.bytes) == 256:
                out += [self.bytes[b] for b in text[at].encode()]
            else:
                out.append(piece)
        return out

    def unit(self, text: str) -> bytes:
        """Packed ids of a whole unit, kept in the cache."""
        known = self.cache.get(text)
        if known is None:
            if len(self.cache) >= CACHED_UNITS:
                self.cache.clear()
                self.unit_scores.clear()
            if self.bpe:
                ids = self._merged_ids(text) if len(text) <= MERGED_CHARS else self.spelled(text, self._only_path(text))
            else:
                n = len(text)
                nodes = self.sweep(text, {(0, FREE): 0.0}, 0, n, n)
                ids = self.spelled(text, self.trace(nodes, 0, (n, FREE)))
                self.unit_scores[text] = nodes[n][FREE][0]
            known = self.cache[text] = np.array(ids, np.int32).tobytes()
        return known

    def unit_score(self, text: str) -> float:
        if self.bpe:
            return 0.0
        self.unit(text)
        return self.unit_scores[text]

    def _merged_ids(self, text: str) -> list[int]:
        """A short BPE unit's ids by the merges themselves: what the only allowed path spells too."""
        out: list[int] = []
        for part in self.merged(text):
            piece = self.vocab.get(part)
            if piece is not None:
                out.append(piece)
            elif len(self.bytes) == 256:
                out += [self.bytes[b] for b in part.encode()]
            else:
                out.append(self.unknown)
        return out

    def _pair_table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Symbol of each character (-1: in no piece), and sorted keys of two symbols with the piece they merge to and its cost.

        A symbol is a piece's id, or a further number for a character that only longer pieces have.
        """
        if self._pairs is None:
            symbol = dict(self.vocab)
            for c in sorted({c for p in self.vocab for c in p}):
                symbol.setdefault(c, len(self.names) + len(symbol))
            of_char = np.full(0x110000, -1, np.int64)
            for text, s in symbol.items():
                if len(text) == 1:
                    of_char[ord(text)] = s
            rows = []
            for piece, i in self.vocab.items():
                for k in range(1, len(piece)):
                    a, b = symbol.get(piece[:k]), symbol.get(piece[k:])
                    if a is not None and b is not None:
                        rows.append((a << 32 | b, i, self.costs[piece]))
            rows.sort()
            self._pairs = of_char, np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.float64)
        return self._pairs

    def merge_many(self, units: list[str]) -> list[bytes]:
        """Packed ids of short BPE units: each round merges the best pair, the leftmost of equals, of every unit at once."""
        of_char, keys, made, costs = self._pair_table()
        if not len(keys):
            return [np.array(self._merged_ids(u), np.int32).tobytes() for u in units]

        def price(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            key = np.where((left < 0) | (right < 0), -1, left << 32 | right)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[at] == key
            return np.where(hit, costs[at], NEVER), made[at]

        symbols = of_char[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)]
        unit = np.repeat(np.arange(len(units)), [len(u) for u in units])
        cost, piece = price(symbols[:-1], symbols[1:])
        cost, piece = np.append(cost, NEVER), np.append(piece, 0)
        cost[:-1][unit[1:] != unit[:-1]] = NEVER
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(unit):
            starts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            best = np.repeat(np.minimum.reduceat(cost, starts), np.diff(np.append(starts, len(unit))))
            over = best == NEVER
            if over.any():
                done.append((unit[over], symbols[over]))
                going = ~over
                unit, symbols, cost, piece, best = unit[going], symbols[going], cost[going], piece[going], best[going]
                if not len(unit):
                    break
            at = np.flatnonzero(cost == best)
            at = at[np.append(True, unit[at[1:]] != unit[at[:-1]])]
            symbols[at] = piece[at]
            stay = np.ones(len(unit), bool)
            stay[at + 1] = False
            # a merged part meets new neighbours on both sides
            place = np.cumsum(stay) - 1
            unit, symbols, cost, piece = unit[stay], symbols[stay], cost[stay], piece[stay]
            at = place[at]
            fresh = np.concatenate([at, at[at > 0] - 1])
            fresh_next = np.minimum(fresh + 1, len(unit) - 1)
            new_cost, piece[fresh] = price(symbols[fresh], symbols[fresh_next])
            cost[fresh] = np.where((fresh_next > fresh) & (unit[fresh] == unit[fresh_next]), new_cost, NEVER)
        unit, symbols = (np.concatenate(c) for c in zip(*done, strict=True))
        order = np.argsort(unit, kind="stable")
        unit, symbols = unit[order], symbols[order]
        ends = 4 * np.cumsum(np.bincount(unit, minlength=len(units)))
        packed = symbols.astype(np.int32).tobytes()
        out = [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        # characters without a piece of their own
        for i in np.unique(unit[(symbols < 0) | (symbols >= len(self.names))]).tolist():
            out[i] = np.array(self._merged_ids(units[i]), np.int32).tobytes()
        return out

    def _only_path(self, text: str) -> list[tuple[int, int]]:
        """A BPE unit's steps. From a single state, at most one allowed path leads to each place, so one key is kept."""
        n, vocab, starts, allowed = len(text), self.vocab, self.starts, self.allowed
        keys: list[int | None] = [FREE] + [None] * n
        back = [0] * (n + 1)
        for at in range(n):
            key = keys[at]
            if key is None:
                continue
            for end in range(at + 1, min(at + self.longest, n) + 1):
                part = text[at:end]
                piece = vocab.get(part)
                if piece is None:
                    if end == at + 1:
                        keys[end], back[end] = FREE, at
                        if part in starts:
                            continue
                        break
                    if part not in starts:
                        break
                    continue
                if keys[end] is None:
                    fits = allowed.get((key, piece))
                    if fits is None:
                        fits = self.may_follow(key, piece)
                    if fits:
                        keys[end], back[end] = piece, at
        out = []
        while n:
            out.append((self.unknown if keys[n] == FREE else keys[n], back[n]))
            n = back[n]
        return out[::-1]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """Neighbouring unknown pieces are one."""
        if len(self.bytes) == 256 or len(ids) < 2:
            return ids
        again = np.concatenate([[False], (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)])
        return ids[~again]

    def encode(self, text: str | None) -> np.ndarray:
        cache, unit = self.cache, self.unit
        packed = b"".join([cache.get(u) or unit(u) for u in self.units.findall(self.normal(text or ""))])
        return self.joined(np.frombuffer(packed, np.int32))

    def encode_all(self, texts: pa.Array) -> pa.Array:
        """``encode`` of many texts as lists: each different unit is looked up once, new ones are merged together."""
        if not self.bpe or self.squeeze or not self.words or len(self.bytes) != 256:
            return _lists([self.encode(t) for t in texts.to_pylist()])
        texts = pc.fill_null(texts, "")
        if self.prefix:
            texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(" ", texts, ""))
        buf, at = text_buffer(texts)
        mark = np.frombuffer(SPACE.encode(), np.uint8)
        ids, sizes = [], [np.zeros(1, np.int64)]
        for lo, hi in blocks(at):
            part, bounds = buf[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
            if len(part) > 2 and ((part[:-2] == mark[0]) & (part[1:-1] == mark[1]) & (part[2:] == mark[2])).any():
                # a text with the mark itself; its characters stand for spaces
                rows = [self.encode(t) for t in texts.slice(lo, hi - lo).to_pylist()] if not self.prefix else [self.encode(t[1:]) for t in texts.slice(lo, hi - lo).to_pylist()]
                ids += rows
                sizes.append(np.array([len(r) for r in rows]))
                continue
            found, count = self._block_ids(part, bounds)
            ids.append(found)
            sizes.append(count)
        offsets = np.cumsum(np.concatenate(sizes)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))

    def _block_ids(self, buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a block of texts, and how many each text has. A unit starts at a text, at a space after something else, around a line feed."""
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(len(at) - 1, np.int64)
        space = buf == 32
        begin = np.zeros(len(buf), bool)
        begin[at[:-1][np.diff(at) > 0]] = True
        begin[1:] |= space[1:] & ~space[:-1]
        if self.lines:
            feed = buf == 10
            begin |= feed
            begin[1:] |= feed[:-1]
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(buf))
        different, where, own = np.unique(span_hash(prefix_hash(BYTE_VALUES[buf]), starts, ends), return_index=True, return_inverse=True)
        known = self.table.find(different)
        if (known < 0).any():
            if len(self.table.hashes) + (known < 0).sum() > CACHED_HASHES:
                self.table = UnitTable()
                known = self.table.find(different)
            new = known < 0
            data = buf.tobytes()
            units = [data[a:b].decode().replace(" ", SPACE) for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)]
            short = [u for u in units if len(u) <= MERGED_CHARS]
            merged = iter(self.merge_many(short) if short else [])
            self.table.add(different[new], [next(merged) if len(u) <= MERGED_CHARS else self.unit(u) for u in units])
            known = self.table.find(different)
        first, size = self.table.start[known][own], self.table.size[known][own]
        done = np.cumsum(size)
        ids = self.table.flat[np.repeat(first - (done - size), size) + np.arange(done[-1])]
        return ids, np.diff(np.append(0, done)[np.searchsorted(starts, at)])

    def decode(self, ids: list[int]) -> str:
        out, raw = [], bytearray()
        low = self.bytes[0] if self.bytes else 0
        for i in ids:
            if self.bytes and low <= i < low + 256:
                raw.append(i - low)
                continue
            if raw:
                out.append(raw.decode(errors="replace"))
                raw.clear()
            if i not in self.hidden:
                out.append(self.names[i])
        if raw:
            out.append(raw.decode(errors="replace"))
        text = "".join(out).replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text

    def spelling(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all pieces, one after another with spaces for their marks, and where each starts."""
        if self._spelling is None:
            low = self.bytes[0] if self.bytes else 0
            names = [
                b"" if i in self.hidden else bytes([i - low]) if self.bytes and low <= i < low + 256 else name.replace(SPACE, " ").encode()
                for i, name in enumerate(self.names)
            ]
            self._spelling = np.frombuffer(b"".join(names), np.uint8), np.concatenate([[0], np.cumsum([len(n) for n in names])])
        return self._spelling

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> list[str] | pa.Array:
        """The texts of rows of ids: pieces are copied as arrays; rows whose bytes are no text are decoded one by one."""
        letters, at = self.spelling()
        begin, size = at[ids], np.diff(at)[ids]
        if self.prefix:
            # the first piece with letters of each row loses the space in front
            shown = np.flatnonzero(size)
            place = np.searchsorted(shown, offsets[:-1])
            first = shown[np.minimum(place, len(shown) - 1)] if len(shown) else shown
            first = first[(place < len(shown)) & (first < offsets[1:])] if len(shown) else first
            first = first[letters[begin[first]] == 32]
            begin[first] += 1
            size[first] -= 1
        ends = np.concatenate([[0], np.cumsum(size)])
        taken = letters[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
        bounds = ends[offsets].astype(np.int32)
        texts = pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(taken)])
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            return [self.decode(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return texts

    # chunks of giant texts: ``text`` has up to ``longest`` characters of its neighbours on both sides

    def parts(self, text: str, begin: int, stop: int) -> tuple[int, int, list[str], int, int]:
        """First and last border of units in a chunk, the whole units between, start and end of the unit around ``begin``.

        Without a border in the chunk both are beyond ``stop``. Where the context is cut off counts as a border.
        """
        borders = [m.start() for m in self.units.finditer(text)] + [len(text)]
        i, j = np.searchsorted(borders, begin, "left"), np.searchsorted(borders, stop, "right") - 1
        lo = begin if borders[i] == begin else borders[i - 1]
        if i > j:
            return stop + 1, stop + 1, [], lo, borders[i]
        return borders[i], borders[j], [text[a:b] for a, b in zip(borders[i:j], borders[i + 1 : j + 1], strict=True)], lo, borders[i]

    def unit_end(self, text: str, at: int) -> int:
        return next((m.end() for m in self.units.finditer(text, at)), len(text))

    def states(self, text: str, at: int, lo: int, hi: int) -> list[State]:
        """All states that may hold at ``at`` in the unit from ``lo`` to ``hi``: how far a piece reaches beyond it, its key."""
        if lo == at:
            return [(0, FREE)]
        found = {(0, FREE)} if not self.bpe or text[at - 1] not in self.vocab else set()
        for end in range(at, min(hi, at + self.longest - 1) + 1):
            for start in range(max(lo, end - self.longest), at):
                piece = self.vocab.get(text[start:end])
                if piece is not None:
                    found.add((end - at, piece if self.bpe else FREE))
        return sorted(found)

    def leaving(self, text: str, entries: dict[State, float], begin: int, stop: int, limit: int) -> tuple[dict[State, float], list]:
        """From ``entries`` at ``begin`` to the states at ``stop`` in a unit that ends at ``limit``; and the sweep."""
        nodes = self.sweep(text, entries, begin, stop, limit)
        return {(e, k): v[0] for e in range(limit - stop + 1) for k, v in nodes[stop + e - begin].items()}, nodes

    def transfer(self, text: str, begin: int, stop: int) -> Transfer:
        """The chunk's max-plus matrix; after the first border of units all entries go the same way."""
        inner, outer, whole, lo, hi = self.parts(text, begin, stop)
        entries = self.states(text, begin, lo, hi)
        if inner > stop:
            return {e: self.leaving(text, {e: 0.0}, begin, stop, hi)[0] for e in entries}
        rest = {(0, FREE): 0.0} if outer == stop else self.leaving(text, {(0, FREE): 0.0}, outer, stop, self.unit_end(text, outer))[0]
        middle = sum(self.unit_score(u) for u in whole)
        out: Transfer = {}
        for e in entries:
            head = {(0, FREE): 0.0} if inner == begin else self.leaving(text, {e: 0.0}, begin, inner, inner)[0]
            if head:
                gain = max(head.values()) + middle
                out[e] = {x: v + gain for x, v in rest.items()}
        return out

    def chunk_ids(self, text: str, begin: int, stop: int, entry: State, leave: State) -> list[int]:
        """The pieces that start in a chunk, on the best path between two states."""
        inner, outer, whole, _, hi = self.parts(text, begin, stop)
        if inner > stop:
            _, nodes = self.leaving(text, {entry: 0.0}, begin, stop, hi)
            return self.spelled(text, self.trace(nodes, begin, (stop - begin + leave[0], leave[1])))
        out: list[int] = []
        if inner > begin:
            found, nodes = self.leaving(text, {entry: 0.0}, begin, inner, inner)
            key = max(found, key=lambda s: found[s])[1]
            out += self.spelled(text, self.trace(nodes, begin, (inner - begin, key)))
        for u in whole:
            out += np.frombuffer(self.unit(u), np.int32).tolist()
        if outer < stop:
            _, nodes = self.leaving(text, {(0, FREE): 0.0}, outer, stop, self.unit_end(text, outer))
            out += self.spelled(text, self.trace(nodes, outer, (stop - outer + leave[0], leave[1])))
        return out


def compose(left: Transfer, right: Transfer) -> Transfer:
    """Max-plus product of two transfer matrices; associative."""
    out: Transfer = {}
    for e, middle in left.items():
        row: dict[State, float] = {}
        for m, a in middle.items():
            for x, b in right.get(m, {}).items():
                if x not in row or a + b > row[x]:
                    row[x] = a + b
        out[e] = row
    return out


def best_states(transfers: list[Transfer]) -> list[State]:
    """The states at all chunk borders on the best path, from the products of the matrices so far, traced back."""
    sums: list[dict[State, float]] = [{(0, FREE): 0.0}]
    for t in transfers:
        sums.append(compose({(0, FREE): sums[-1]}, t)[0, FREE])
    state = max(sums[-1], key=lambda s: sums[-1][s])
    out = [state]
    for t, before in zip(transfers[::-1], sums[-2::-1], strict=True):
        state = max((s for s in before if out[-1] in t.get(s, {})), key=lambda s: before[s] + t[s][out[-1]])
        out.append(state)
    return out[::-1]


_loaded: dict[int, Pieces] = {}


def _model(data: bytes) -> Pieces:
    """One model for each worker, so that its caches serve all batches."""
    key = hash(data)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Pieces(data)
    return _loaded[key]


def _lists(rows: list) -> pa.Array:
    """Id sequences as an Arrow list column."""
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate([np.asarray(r, np.int32) for r in rows]) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _giants(docs: DataFrame, sent, chunk_chars: int) -> DataFrame:
    """``_id``, ``_text_hash``, ``ids`` of giant texts, by chunks."""
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*anchors.KEY).schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(sent.value)
        for batch in batches:
            for i, value in enumerate(batch.column(2)):
                text, side = model.normal(value.as_py()), model.longest
                at = list(range(0, len(text), chunk_chars)) or [0]
                own = batch.slice(i, 1).select([0, 1]).take(pa.array([0] * len(at)))
                begins = [min(a, side) for a in at]
                yield pa.RecordBatch.from_arrays([
                    *own.columns, pa.array(range(len(at)), pa.int32()),
                    pa.array([text[max(0, a - side) : a + chunk_chars + side] for a in at]), pa.array(begins, pa.int32()),
                    pa.array([b + min(chunk_chars, len(text) - a) for a, b in zip(at, begins, strict=True)], pa.int32()),
                ], names=[*anchors.KEY, "chunk", "text", "begin", "stop"])

    chunks = stored(docs.mapInArrow(cut, f"{keys}, chunk int, text string, begin int, stop int").dropDuplicates([*anchors.KEY, "chunk"]))

    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(sent.value)
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in ("row", "r1", "k1", "r2", "k2", "w")}
            for i, (text, begin, stop) in enumerate(zip(*(batch[c].to_pylist() for c in ("text", "begin", "stop")), strict=True)):
                for (r1, k1), line in model.transfer(text, begin, stop).items():
                    for (r2, k2), w in line.items():
                        for name, v in zip(rows, (i, r1, k1, r2, k2, w), strict=True):
                            rows[name].append(v)
            own = batch.select([*anchors.KEY, "chunk"]).take(pa.array(rows.pop("row"), pa.int64()))
            yield pa.RecordBatch.from_arrays([*own.columns, *(pa.array(v, pa.int32() if k != "w" else pa.float64()) for k, v in rows.items())], names=[*anchors.KEY, "chunk", *rows])

    matrices = chunks.mapInArrow(transfers, f"{keys}, chunk int, r1 int, k1 int, r2 int, k2 int, w double")

    def best(part: pa.Table) -> pa.Table:
        n = max(part["chunk"].to_pylist()) + 1
        line: list[Transfer] = [{} for _ in range(n)]
        for c, r1, k1, r2, k2, w in zip(*(part[x].to_pylist() for x in ("chunk", "r1", "k1", "r2", "k2", "w")), strict=True):
            line[c].setdefault((r1, k1), {})[r2, k2] = w
        states = best_states(line)
        own = part.select(anchors.KEY).take(pa.array([0] * n))
        columns = {"chunk": range(n), "r1": [s[0] for s in states[:-1]], "k1": [s[1] for s in states[:-1]], "r2": [s[0] for s in states[1:]], "k2": [s[1] for s in states[1:]]}
        for name, values in columns.items():
            own = own.append_column(name, pa.array(values, pa.int32()))
        return own

    path = matrices.groupBy(*anchors.KEY).applyInArrow(best, f"{keys}, chunk int, r1 int, k1 int, r2 int, k2 int")
    same = chunks["_id"].eqNullSafe(path["_id"]) & (chunks["_text_hash"] == path["_text_hash"]) & (chunks["chunk"] == path["chunk"])
    routed = chunks.join(path, same).select(*[chunks[c] for c in chunks.columns], "r1", "k1", "r2", "k2")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(sent.value)
        for batch in batches:
            names = ("text", "begin", "stop", "r1", "k1", "r2", "k2")
            ids = [model.chunk_ids(t, b, s, (r1, k1), (r2, k2)) for t, b, s, r1, k1, r2, k2 in zip(*(batch[c].to_pylist() for c in names), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.select([*anchors.KEY, "chunk"]).columns, _lists(ids)], names=[*anchors.KEY, "chunk", "ids"])

    spelled = routed.mapInArrow(spell, f"{keys}, chunk int, ids array<int>")
    parts = spelled.groupBy(*anchors.KEY).agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("p"))
    whole = parts.select(*anchors.KEY, F.flatten("p.ids").alias("ids"))

    def join_unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(sent.value)
        for batch in batches:
            ids = [model.joined(np.array(x, np.int32)) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.select(anchors.KEY).columns, _lists(ids)], names=[*anchors.KEY, "ids"])

    # only models without byte pieces have unknown pieces to join
    return whole if len(Pieces(sent.value).bytes) == 256 else whole.mapInArrow(join_unknown, f"{keys}, ids array<int>")


def encode(documents: DataFrame, model_path: str, *, giant_chars: int = 50_000, chunk_chars: int = 8_192, id_col: str = "doc_id", text_col: str = "text", extra: list[str] | None = None) -> DataFrame:
    """``id_col``, ``extra`` and ``ids`` for every row; texts above ``giant_chars`` are scanned in chunks of ``chunk_chars``."""
    with open(model_path, "rb") as f:
        data = f.read()
    Pieces(data)  # a model that does not fit raises here
    sent = documents.sparkSession.sparkContext.broadcast(data)
    giant = F.coalesce(F.length(text_col), F.lit(0)) > giant_chars
    kept = [id_col, *(c for c in extra or [] if c != id_col)]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_kept")
    small = documents.where(~giant).select(row, F.col(text_col).alias("_text"))
    schema = small.select("_kept").schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = _model(sent.value)
        for batch in batches:
            for lo in range(0, len(batch), 500):
                part = batch.slice(lo, 500)
                ids = here.encode_all(part["_text"])
                yield pa.RecordBatch.from_arrays([part["_kept"], ids], names=["_kept", "ids"])

    plain = small.mapInArrow(run, schema).select("_kept.*", "ids")
    large = anchors.keyed(documents.where(giant), id_col, text_col, kept)
    found = _giants(large.select(*anchors.KEY, "_text"), sent, chunk_chars)
    rows = large.select(F.col("_id").alias("_i"), F.col("_text_hash").alias("_h"), "_extra")
    found = rows.join(found, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_text_hash")))
    return plain.unionByName(found.select("_extra.*", "ids"))


def decode(encoded: DataFrame, model_path: str, *, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text that the pieces spell; null ids give a null text."""
    with open(model_path, "rb") as f:
        sent = encoded.sparkSession.sparkContext.broadcast(f.read())
    place = encoded.columns.index(ids_col)
    schema = encoded.select("*").schema.add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(sent.value)
        for batch in batches:
            for lo in range(0, len(batch), 500):
                part = batch.slice(lo, 500)
                own = part.column(place)
                # a null row has no ids; its text is null again
                sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(own), 0).to_numpy(zero_copy_only=False))])
                texts = model.decode_all(own.flatten().to_numpy(zero_copy_only=False).astype(np.int64), sizes)
                texts = pc.if_else(own.is_valid(), pa.array(texts, pa.string()) if isinstance(texts, list) else texts, pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)

