"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The transducer is the composition of the normaliser (a leading mark, spaces become marks), the pieces
and a byte fallback for characters without a piece. How the pieces are weighed depends on the model:

- Trained by merges (``model_type`` 2): the scores are the order of the merges, so the pieces are a cascade
  of rewritings. Of the neighbours that spell a piece, those with the best score are rewritten to it, the
  leftmost first, until no neighbours spell one. The ids are those that the model itself gives.
- Else: costs are the negated scores. The tropical-semiring shortest path gives the pieces: costs add
  along a path, the least path wins, and of equal ones that with fewer pieces.

Pieces never hold a mark behind another character, so texts fall apart at the marks (and at line breaks,
which are in no piece); each stretch is solved by itself, many at a time, and remembered in a bounded cache.

Null and empty texts have no pieces. Decoding returns the text, with the mark character itself read as a
space. Repeated rows are encoded alike.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE = 200_000
BLOCK = 20_000  # stretches solved together
LONG = 100  # characters from which a stretch is solved alone
BYTE_COST = 1e6


class Transducer:
    def __init__(self, model: str = MODEL):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        sp = SentencePieceProcessor(model_file=model)
        proto = sentencepiece_model_pb2.ModelProto.FromString(sp.serialized_model_proto())
        self.by_merges = proto.trainer_spec.model_type == proto.trainer_spec.BPE
        self.pieces: dict[str, tuple[float, int]] = {}
        self.bytes: list[int] = [0] * 256
        self.output: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.output.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.output.append(b"")
            else:
                self.pieces[piece] = (-sp.get_score(i), i)
                self.output.append(piece.replace(MARK, " ").encode())
        # Every prefix of a piece is a state of the transducer; a whole piece emits it at its cost.
        self.states: dict[str, tuple[float, int] | None] = {
            p[:j]: None for p in self.pieces for j in range(1, len(p) + 1)}
        self.states.update(self.pieces)
        alone = "".join(c for c in "\n\r\t" if not any(c in p for p in self.pieces))
        inner = any(MARK in p.lstrip(MARK) for p in self.pieces)
        self.stretch = re.compile(".+" if inner else f"[{alone}]|{MARK}*[^{MARK}{alone}]+|{MARK}+" if alone
                                  else f"{MARK}*[^{MARK}]+|{MARK}+", re.S)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._number_states()
        if self.by_merges:
            self._number_merges()

    def _number_states(self) -> None:
        """The states as numbers: sorted (state, character class) moves, and what each state emits."""
        names = sorted(self.states)
        number = {"": 0} | {p: i for i, p in enumerate(names, 1)}
        chars = sorted({c for p in names for c in p})
        self.char_class = np.zeros(0x110000, np.int32)
        self.char_class[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.n_classes = len(chars) + 1
        moves = np.array([number[p[:-1]] * self.n_classes + self.char_class[ord(p[-1])] for p in names], np.int64)
        order = np.argsort(moves)
        self.moves, self.move_to = moves[order], np.arange(1, len(names) + 1)[order]
        self.emit_cost = np.array([np.inf] + [self.pieces.get(p, (np.inf, 0))[0] for p in names])
        self.emit_id = np.array([0] + [self.pieces.get(p, (0.0, 0))[1] for p in names], np.int32)
        self.longest = max(map(len, names), default=0)
        self.alone = np.zeros(self.n_classes, bool)  # classes of characters that are pieces by themselves
        self.alone[[self.char_class[ord(c)] for c in chars if c in self.pieces]] = True

    def _number_merges(self) -> None:
        """Symbols (pieces and single characters) as numbers; for each two that spell a piece its rank and number."""
        names = sorted(set(self.pieces).union(*self.pieces))
        number = {p: i for i, p in enumerate(names, 1)}  # 0: a character in no piece
        self.n_symbols = len(names) + 1
        self.symbol_of = np.zeros(0x110000, np.int64)
        single = [p for p in names if len(p) == 1]
        self.symbol_of[[ord(c) for c in single]] = [number[c] for c in single]
        self.symbol_id = np.array([-1] + [self.pieces.get(p, (0.0, -1))[1] for p in names], np.int32)
        ranks = {c: i for i, c in enumerate(sorted({c for c, _ in self.pieces.values()}))}  # equal scores, equal ranks
        self.no_rank = len(ranks)
        self.merges = {
            number[p[:j]] * self.n_symbols + number[p[j:]]: (ranks[c], number[p])
            for p, (c, _) in self.pieces.items() for j in range(1, len(p)) if p[:j] in number and p[j:] in number}
        self.merge_keys = np.array(sorted(self.merges), np.int64)
        found = [self.merges[k] for k in self.merge_keys.tolist()]
        self.merge_rank = np.array([r for r, _ in found], np.int64)
        self.merge_to = np.array([to for _, to in found], np.int64)

    def _spelled(self, symbol: int, char: str) -> list[int]:
        """Ids of a symbol; ``char`` is its character, of which the bytes stand for it if it is no piece."""
        i = int(self.symbol_id[symbol])
        return [i] if i >= 0 else [self.bytes[b] for b in char.encode()]

    def merged(self, text: str) -> list[int]:
        """Ids of a normalised text by merge order."""
        n = len(text)
        symbols = self.symbol_of[np.frombuffer(text.encode("utf-32-le"), np.uint32)].tolist()
        after, before, size = [*range(1, n + 1)], [*range(-1, n - 1)], [1] * n
        agenda: list[tuple[int, int, int, int, int]] = []

        def meet(i, j):
            hit = self.merges.get(symbols[i] * self.n_symbols + symbols[j])
            if hit:
                heapq.heappush(agenda, (hit[0], i, j, size[i] + size[j], hit[1]))

        for i in range(n - 1):
            meet(i, i + 1)
        while agenda:
            _, i, j, length, to = heapq.heappop(agenda)
            if not size[i] or not size[j] or size[i] + size[j] != length:
                continue
            symbols[i], size[i], size[j], after[i] = to, length, 0, after[j]
            if after[i] < n:
                before[after[i]] = i
                meet(i, after[i])
            if before[i] >= 0:
                meet(before[i], i)
        return [x for i in range(n) if size[i] for x in self._spelled(symbols[i], text[i])]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of neighbours; ``no_rank`` where they spell no piece."""
        if not len(self.merge_keys):
            return np.full(left.shape, self.no_rank), np.zeros(left.shape, np.int64)
        key = left * self.n_symbols + right
        at = np.minimum(np.searchsorted(self.merge_keys, key), len(self.merge_keys) - 1)
        known = self.merge_keys[at] == key
        return np.where(known, self.merge_rank[at], self.no_rank), np.where(known, self.merge_to[at], 0)

    def merged_of_many(self, stretches: list[str]) -> list[bytes]:
        """Ids of many non-empty stretches: ``merged`` with all of them in step, one merge of each at a time."""
        m = len(stretches)
        size = np.array([len(s) for s in stretches])
        width = int(size.max())
        code = np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32)
        first = np.cumsum(size) - size
        row = np.repeat(np.arange(m), size)
        place = np.arange(len(code)) - first[row]
        # Column ``width`` and what is behind a stretch's end hold symbol 0, which merges with nothing.
        symbol = np.zeros((m, width + 1), np.int64)
        symbol[row, place] = self.symbol_of[code]
        start = np.zeros((m, width + 1), np.int32)  # of each symbol, in ``code``
        start[row, place] = np.arange(len(code))
        rank = np.full((m, width), self.no_rank, np.int64)
        to = np.zeros((m, width), np.int64)
        rank[row, place], to[row, place] = self._ranks(symbol[row, place], symbol[row, place + 1])
        done = [np.zeros(0, np.int64)] * 3
        kept: list[list[np.ndarray]] = [done]
        live, count, columns = np.arange(m), size.copy(), np.arange(width + 1)

        def finish(which):
            at, col = np.nonzero(columns[:symbol.shape[1]] < count[which][:, None])
            kept.append([live[which][at], start[which][at, col], symbol[which][at, col]])

        while len(live):
            best = rank.argmin(1)  # the leftmost of equal ones
            every = np.arange(len(live))
            more = rank[every, best] < self.no_rank
            if not more.all():
                finish(~more)
                live, count, best = live[more], count[more], best[more]
                if not len(live):
                    break
                short = int(count.max())
                symbol, start = symbol[more, :short + 1], start[more, :short + 1]
                rank, to = rank[more, :short], to[more, :short]
                every = np.arange(len(live))
            symbol[every, best] = to[every, best]
            # What stands behind the right neighbour moves up by one.
            cols = columns[:rank.shape[1]]
            source = np.minimum(cols + (cols > best[:, None]), rank.shape[1] - 1)
            symbol[:, :-1] = np.take_along_axis(symbol, cols + (cols > best[:, None]), 1)
            start[:, :-1] = np.take_along_axis(start, cols + (cols > best[:, None]), 1)
            rank, to = np.take_along_axis(rank, source, 1), np.take_along_axis(to, source, 1)
            symbol[:, -1], rank[:, -1], count = 0, self.no_rank, count - 1
            rank[every, best], to[every, best] = self._ranks(symbol[every, best], symbol[every, best + 1])
            inner = every[best > 0]
            at = best[inner]
            rank[inner, at - 1], to[inner, at - 1] = self._ranks(symbol[inner, at - 1], symbol[inner, at])

        of, begin, last = (np.concatenate(x) for x in zip(*kept))
        order = np.argsort(begin, kind="stable")
        of, begin, ids = of[order], begin[order], self.symbol_id[last[order]]
        raw = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)  # bytes of the character
        n = np.where(ids >= 0, 1, raw[begin])
        stop = np.cumsum(n)
        out = np.zeros(int(stop[-1]), np.int32)
        out[(stop - n)[ids >= 0]] = ids[ids >= 0]
        for k in np.nonzero(ids < 0)[0].tolist():
            out[stop[k] - n[k]:stop[k]] = [self.bytes[b] for b in chr(code[begin[k]]).encode()]
        ends = np.cumsum(np.bincount(of, n, m)).astype(np.int64).tolist()
        blob = out.tobytes()
        return [blob[4 * a:4 * b] for a, b in zip([0, *ends], ends)]

    def shortest(self, text: str) -> tuple[float, list[int]]:
        """(cost, ids) of the shortest path over a normalised text."""
        n, state, pieces = len(text), self.states.get, self.pieces
        cost, steps = [float("inf")] * (n + 1), [0] * (n + 1)
        start_of, piece_of = [0] * (n + 1), [0] * (n + 1)
        cost[0] = 0.0
        for i in range(n):
            here, more = cost[i], steps[i] + 1
            part = text[i]
            if part not in pieces:
                raw = len(part.encode())
                new, longer = here + BYTE_COST * raw, steps[i] + raw
                if new < cost[i + 1] or (new == cost[i + 1] and longer < steps[i + 1]):
                    cost[i + 1], steps[i + 1], start_of[i + 1], piece_of[i + 1] = new, longer, i, -1
            for j in range(i + 1, n + 1):
                hit = state(text[i:j], 0)
                if hit:
                    new = here + hit[0]
                    if new < cost[j] or (new == cost[j] and more < steps[j]):
                        cost[j], steps[j], start_of[j], piece_of[j] = new, more, i, hit[1]
                elif hit == 0:
                    break
        out: list[int] = []
        at = n
        while at:
            start, piece = start_of[at], piece_of[at]
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.bytes[b] for b in reversed(text[start:at].encode()))
            at = start
        return cost[n], out[::-1]

    def normalise(self, text: str) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def shortest_of_many(self, stretches: list[str]) -> list[bytes]:
        """Ids of many non-empty stretches: the search of ``shortest`` with all of them in step, longest first."""
        m = len(stretches)
        size = np.array([len(s) for s in stretches])
        order = np.argsort(-size, kind="stable")
        size, width = size[order], int(size.max())
        code = np.frombuffer("".join(stretches[i] for i in order).encode("utf-32-le"), np.uint32)
        first = np.cumsum(size) - size
        row = np.repeat(np.arange(m), size)
        place = np.arange(len(code)) - first[row]
        kind = np.zeros((width, m), np.int64)
        kind[place, row] = self.char_class[code]
        raw = np.zeros((width, m), np.int32)  # bytes of the character
        raw[place, row] = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        cost = np.full((width + 1, m), np.inf)
        cost[0] = 0.0
        steps, back, piece = np.zeros((3, width + 1, m), np.int32)

        def relax(j, rows, new, more, length, ids):
            better = (new < cost[j, rows]) | ((new == cost[j, rows]) & (more < steps[j, rows]))
            at = rows[better]
            cost[j, at], steps[j, at], back[j, at], piece[j, at] = new[better], more[better], length, ids[better]

        longer = np.searchsorted(-size, -np.arange(1, width + 1), "right")  # stretches of that many characters or more
        for i in range(width):
            rows = np.arange(longer[i])
            other = rows[~self.alone[kind[i, rows]]]
            if len(other):
                n = raw[i, other]
                relax(i + 1, other, cost[i, other] + BYTE_COST * n, steps[i, other] + n, 1, np.full(len(other), -1))
            state = np.zeros(len(rows), np.int64)
            for j in range(i + 1, min(width, i + self.longest) + 1):
                fit = np.searchsorted(rows, longer[j - 1])
                rows = rows[:fit]
                move = state[:fit] * self.n_classes + kind[j - 1, rows]
                to = np.minimum(np.searchsorted(self.moves, move), len(self.moves) - 1)
                known = self.moves[to] == move
                rows, state = rows[known], self.move_to[to[known]]
                if not len(rows):
                    break
                whole = np.isfinite(self.emit_cost[state])
                at, end = rows[whole], state[whole]
                relax(j, at, cost[i, at] + self.emit_cost[end], steps[i, at] + 1, j - i, self.emit_id[end])

        total = steps[size, np.arange(m)]
        stop = np.cumsum(total)
        out, free = np.zeros(int(stop[-1]), np.int32), stop.copy()
        rows, at = np.arange(m), size.copy()
        while len(rows):
            ids = piece[at[rows], rows]
            for r in rows[ids < 0]:
                spelled = [self.bytes[b] for b in chr(code[first[r] + at[r] - 1]).encode()]
                out[free[r] - len(spelled):free[r]] = spelled
                free[r] -= len(spelled)
            some = rows[ids >= 0]
            free[some] -= 1
            out[free[some]] = ids[ids >= 0]
            at[rows] -= back[at[rows], rows]
            rows = rows[at[rows] > 0]
        blob = out.tobytes()
        found: list[bytes] = [b""] * m
        for i, a, b in zip(order.tolist(), (stop - total).tolist(), stop.tolist()):
            found[i] = blob[4 * a:4 * b]
        return found

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        rows = [self.stretch.findall(self.normalise(x)) for x in texts]
        distinct = set().union(*rows)
        if len(self.cache) + len(distinct) > CACHE:
            self.older, self.cache = self.cache, {}
        ids: dict[str, bytes] = {}
        missing = []
        for s in distinct:
            found = self.cache.get(s) or self.older.get(s)
            if found is not None:
                ids[s] = found
            elif len(s) < LONG:
                missing.append(s)
            else:
                ids[s] = np.array(self.merged(s) if self.by_merges else self.shortest(s)[1], np.int32).tobytes()
        missing.sort(key=len)
        for at in range(0, len(missing), BLOCK):
            block = missing[at:at + BLOCK]
            ids.update(zip(block, self.merged_of_many(block) if self.by_merges else self.shortest_of_many(block)))
        if len(distinct) <= CACHE:
            self.cache.update((s, found) for s, found in ids.items() if len(s) < LONG)
        return [np.frombuffer(b"".join(map(ids.__getitem__, r)), np.int32) for r in rows]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    def decode(self, ids) -> str:
        raw = b"".join(map(self.output.__getitem__, ids))
        return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


_READY: dict[str, Transducer] = {}


def transducer(model: str) -> Transducer:
    if model not in _READY:
        _READY[model] = Transducer(model)
    return _READY[model]


def encoded(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, n_pieces, round_trip) for each row of ``docs``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [x or "" for x in part.column(1).to_pylist()]
                rows = t.encode_many(texts)
                exact = [t.decode(r.tolist()) == x.replace(MARK, " ") for r, x in zip(rows, texts)]
                n = np.array([len(r) for r in rows], np.int64)
                ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)),
                                               pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids, pa.array(n), pa.array(exact)],
                                                 names=[id_col, "ids", "n_pieces", "round_trip"])

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return rows.mapInArrow(encode, f"`{id_col}` long, ids array<int>, n_pieces long, round_trip boolean")


def decoded(rows: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the texts that the piece ids spell; a null array gives an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [t.decode(x or []) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return rows.select(F.col(id_col).cast("long"), ids_col).mapInArrow(decode, f"`{id_col}` long, text string")


def op3_sentencepiece(spark, sf_dir):
    """Pieces of every document, and whether they decode to its text."""
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
