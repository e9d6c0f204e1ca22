"""SentencePiece encoding and decoding by a streaming Viterbi pass.

The lattice has one node per character position and one arc per vocabulary piece.
A window of the last ``max_piece`` positions is enough to extend it, and whenever
the back pointers of all nodes in the window lead through one common boundary, the
ids before that boundary are final and are given out, so memory does not depend on
the length of the text.

The public model is a BPE model: its ids are those of greedy merging, not of the
highest score sum. An arc is therefore admissible only if merging its piece together
with the piece before it gives exactly these two pieces again. Every prefix of a
text then has exactly one admissible path, and it is the library's segmentation.
Models whose scores are log probabilities (unigram) take the arc of the best score
sum instead.

No piece holds a word mark after another character, so every path passes the place
before a run of spaces: there the paths converge and all ids are committed. The
distinct parts of a batch between such places advance in step, one character a turn,
over the window, and commit as they go. Parts longer than the window are first cut
where no piece that stands in them reaches across, which all paths pass as well. What
is still long, such as a run of one letter, advances from several places at once; a
guessed start is taken only once its pieces are for a whole window those of the lane
before, on which alone all that follows depends.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from leafmill.llm.chunks import Chunks, grouped, ranges, spaced_of
from leafmill.llm.int_table import IntTable
from leafmill.runtime import ship_package

WORD_MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
UNIGRAM = 1
#: What an unknown character costs a unigram path beyond the worst piece.
UNKNOWN_PENALTY = 10.0
#: Long parts without a place where all paths meet advance from so many characters to the next lane's start, and so many beyond it.
STRETCH, OVERLAP = 1680, 128
#: Stands for a character outside a part.
UNUSED_CHAR = (1 << 21) - 2
#: Code points and piece ids take so many bits.
BITS = 21
SCHEMA = "doc_id long, n_chars long, n_tokens long, ids_crc32 long, decoded boolean"


class PieceModel:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as source:
            proto.ParseFromString(source.read())
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models with the identity normalizer are supported")
        if proto.trainer_spec.treat_whitespace_as_suffix or any(p.type == USER for p in proto.pieces):
            raise ValueError("word marks at the end and user-defined pieces are not supported")
        self.prefix = WORD_MARK if spec.add_dummy_prefix else ""
        self.unigram = proto.trainer_spec.model_type == UNIGRAM
        self.names = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = {p: proto.pieces[i].score for p, i in self.ids.items()}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.max_piece = max(map(len, self.ids))
        self.floor = min(self.scores.values()) - UNKNOWN_PENALTY
        self.splits = not any(WORD_MARK in p.lstrip(WORD_MARK) for p in self.ids)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.sound: dict[str, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Greedy merging of a short text: the best-scored neighbouring pair first, the leftmost on ties."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, left: str | None, piece: str) -> bool:
        """Whether the BPE encoding can hold ``piece`` right after ``left``."""
        ok = self.sound.get(piece)
        if ok is None:
            ok = self.sound[piece] = len(piece) == 1 or self.merged(piece) == [piece]
        if not ok or left is None:
            return ok
        pair = (left, piece)
        ok = self.pairs.get(pair)
        if ok is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            ok = self.pairs[pair] = self.merged(left + piece) == [left, piece]
        return ok

    def piece_ids(self, piece: str) -> list[int]:
        known = self.ids.get(piece)
        if known is not None:
            return [known]
        return [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that form no character become U+FFFD each, as the library does."""
        out, raw = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(raw):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(raw[at : at + size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    size = 1
                at += size
            raw.clear()

        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                raw.append(byte)
                continue
            flush()
            if self.kinds[i] != CONTROL:
                out.append(" ⁇ " if i == self.unknown else self.names[i])
        flush()
        text = "".join(out).replace(WORD_MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


class WindowLattice:
    """The lattice of many lanes of text at once, one character a step, over a window of positions.

    A lane is a part of a text, or a stretch of a long one. Pieces are found from their
    last character backwards along a trie. A character that is no piece is an arc of its
    own, with an id after the vocabulary's. Only the window is held: whenever it is two
    pieces wide each lane gives out the ids up to the boundary that the paths from its last
    ``max_piece`` positions lead through, and the window is cut to what is left.
    """

    def __init__(self, model: PieceModel, stretch: int = STRETCH, overlap: int = OVERLAP):
        self.model, self.n_names = model, len(model.names)
        self.stretch, self.overlap = stretch, overlap
        self.start = (1 << BITS) - 1  # stands left of a lane's first piece
        self.widest = 0  # positions that the window has held at most
        children: dict[tuple[int, int], int] = {}
        piece_at = [-1]
        for piece, i in model.ids.items():
            node = 0
            for c in reversed(piece):
                edge = (node, ord(c))
                node = children.get(edge, 0)
                if not node:
                    node = children[edge] = len(piece_at)
                    piece_at.append(-1)
            piece_at[node] = i
        self.piece_at = np.array(piece_at, np.int32)
        self.trie = IntTable(max(4, (4 * len(children)).bit_length()))
        self.trie.put(np.array([n << BITS | c for n, c in children], np.int64), np.fromiter(children.values(), np.int32, len(children)))
        self.scores = np.full(self.n_names, model.floor)
        for piece, i in model.ids.items():
            self.scores[i] = model.scores[piece]
        self.pairs = IntTable(21)

    def _name(self, i: int) -> str:
        return self.model.names[i] if i < self.n_names else chr(i - self.n_names)

    def _follows(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the BPE encoding can hold each right piece after the left one; pairs met before are remembered."""
        keys = left.astype(np.int64) << BITS | right
        known = self.pairs.get(keys)
        lacking = np.flatnonzero(known < 0)
        if len(lacking):
            fresh = np.unique(keys[lacking])
            if self.pairs.used + len(fresh) > 1 << (self.pairs.bits - 1):
                self.pairs = IntTable(max(21, (2 * len(fresh)).bit_length()))
            model, low = self.model, (1 << BITS) - 1
            verdicts = [model.follows(None if k >> BITS == self.start else self._name(k >> BITS), self._name(k & low)) for k in fresh.tolist()]
            self.pairs.put(fresh, np.array(verdicts, np.int32))
            known[lacking] = np.array(verdicts, np.int32)[np.searchsorted(fresh, keys[lacking])]
        return known > 0

    def _arcs(self, here: np.ndarray, before: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(length - 1, rows, pieces, all rows still open) of the pieces that end with the characters ``here``; ``before`` are those before them, the nearest first.

        What is sent back are the open rows to go on with.
        """
        open_, node = np.arange(len(here)), np.zeros(len(here), np.int64)
        for back, row in enumerate([here, *before]):
            chars = row[open_]
            node = self.trie.get(node << BITS | chars).astype(np.int64)
            ends = np.where(node >= 0, self.piece_at[node], -1)
            if not back:
                ends = np.where(ends >= 0, ends, (chars + self.n_names).astype(np.int32))
            some = np.flatnonzero(ends >= 0)
            done = yield back, open_[some], ends[some], open_
            alive = node >= 0
            if done is not None:
                alive &= ~done[open_]
            open_, node = open_[alive], node[alive]
            if not len(open_):
                break

    def _certain(self, text: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether each character begins a piece on every path: no piece that is in the text reaches over its start. ``first`` is where its part begins."""
        size, block = self.model.max_piece, 1 << 18
        over = np.zeros(len(text) + 1, np.int64)
        for a in range(0, len(text), block):
            at = np.arange(a, min(len(text), a + block))
            room = at - first[at]
            longest = np.zeros(len(at), np.int64)
            before = [np.where(room >= k, text[np.maximum(at - k, 0)], UNUSED_CHAR).astype(np.int64) for k in range(1, size)]
            for back, rows, _, _ in self._arcs(text[at].astype(np.int64), before):
                longest[rows] = back
            over += np.bincount(at - longest + 1, minlength=len(text) + 1)[: len(text) + 1]
            over -= np.bincount(at + 1, minlength=len(text) + 1)[: len(text) + 1]
        return np.cumsum(over)[:-1] == 0

    def segment(self, text: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts and their number for each; ``text`` holds the code points of the parts in a row."""
        ends = np.cumsum(lengths)
        begins = ends - lengths
        # Parts longer than the window are cut where all paths are known to meet.
        wide = lengths > 2 * self.model.max_piece
        cuts = begins[lengths > 0]
        if wide.any():
            within = ranges(np.arange(len(text)), begins[wide], lengths[wide])
            certain = self._certain(text[within], np.repeat(np.cumsum(lengths[wide]) - lengths[wide], lengths[wide]))
            cuts = np.union1d(cuts, within[certain])
        stops = np.append(cuts[1:], len(text)) if len(cuts) else cuts
        long = (stops - cuts > self.stretch + self.overlap + self.model.max_piece) & (not self.model.unigram)
        nothing = np.zeros(int((~long).sum()), bool)
        at, ids, _ = self._advance(text, cuts[~long], stops[~long], nothing, nothing, False)
        if long.any():
            more, more_ids = self._stretched(text, [lane for a, b in zip(cuts[long].tolist(), stops[long].tolist()) for lane in self._stretches(a, b)])
            at, ids = np.append(at, more), np.append(ids, more_ids)
            order = at.argsort()
            at, ids = at[order], ids[order]
        return ids, np.diff(np.searchsorted(at, np.append(begins, len(text)), "right"))

    def _stretches(self, a: int, b: int) -> list[tuple[int, int, int]]:
        """Lanes (start, end, end of the part) of a part that advance at once."""
        starts = [a, *range(a + self.stretch, b - self.overlap - self.model.max_piece, self.stretch)]
        return [(s, min(b, t + self.overlap), b) for s, t in zip(starts, [*starts[1:], b])]

    def _stretched(self, text: np.ndarray, lanes: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """(ends, ids) of all pieces of the lanes' parts, by place.

        A lane that begins within a part is a guess: it is right from where its pieces have
        been those of the lane before it for a whole window, as what follows depends on the
        window alone. Lanes that never agree are joined and gone through again as one.
        """
        found: dict[tuple[int, int], tuple] = {}
        while True:
            next_to = [k > 0 and lanes[k - 1][2] == lane[2] for k, lane in enumerate(lanes)]
            fresh = [k for k, lane in enumerate(lanes) if lane[:2] not in found]
            if fresh:
                starts, ends, whole = (np.array(x, np.int64) for x in zip(*(lanes[k] for k in fresh)))
                at, ids, special = self._advance(text, starts, ends, np.array([next_to[k] for k in fresh]), ends < whole)
                # Lanes overlap, so their pieces come lane by lane.
                for i, k in enumerate(fresh):
                    part, *rest = special[i]
                    found[lanes[k][:2]] = (at[part], ids[part], *rest)
            joined, agreed = [], True
            for k, lane in enumerate(lanes):
                if next_to[k] and not np.array_equal(found[lanes[k - 1][:2]][2], found[lane[:2]][3]):
                    joined[-1] = (joined[-1][0], lane[1], lane[2])
                    agreed = False
                else:
                    joined.append(lane)
            if agreed:
                break
            lanes = joined
        places, pieces = [], []
        entry = None  # where the path of the lane to the right begins to be its own
        for k in range(len(lanes) - 1, -1, -1):
            at, ids, _, _, rest = found[lanes[k][:2]]
            if rest is not None:
                more, more_ids = rest(entry)
                at, ids = np.append(at, more), np.append(ids, more_ids)
            if next_to[k]:
                keep = int(np.searchsorted(at, lanes[k - 1][1], "right"))
                entry = int(at[keep - 1]) if keep else lanes[k][0]
                at, ids = at[keep:], ids[keep:]
            places.append(at)
            pieces.append(ids)
        return np.concatenate(places[::-1]), np.concatenate(pieces[::-1])

    def _advance(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, inner: np.ndarray, unfinished: np.ndarray, known: bool = True) -> tuple[np.ndarray, np.ndarray, dict[int, tuple]]:
        """(ends, ids) of the lanes' pieces, lane by lane, and what is to be ``known`` of each lane where lanes are stretches of one part.

        ``inner`` lanes begin within a part and keep their pieces at the end of the overlap;
        ``unfinished`` ones end within it: their last ids wait for the next lane. Known are
        (the lane's share of the pieces, its last pieces, those at the overlap, its rest).
        """
        size, unigram = self.model.max_piece, self.model.unigram
        order = np.argsort(starts - ends, kind="stable")
        source, sizes = starts[order], (ends - starts)[order]
        inner, unfinished = inner[order], unfinished[order]
        base = np.zeros(len(order), np.int64)
        window: list[tuple] = []  # of the last positions: characters, pieces, their lengths, path scores; the latest first
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        marks: dict[int, np.ndarray] = {}
        tails: dict[int, tuple] = {}

        def trace(lanes: np.ndarray, at: np.ndarray, upto: int, pieces: np.ndarray, widths: np.ndarray) -> None:
            """Give out the pieces from the nodes ``at`` (counted from the window's start) back to the lanes' bases."""
            deep = len(pieces)
            floor = base[lanes] - (upto - deep)
            while len(lanes):
                more = at > floor
                lanes, at, floor = lanes[more], at[more], floor[more]
                if not len(lanes):
                    break
                rows = deep - at
                out.append((lanes, at + (upto - deep), pieces[rows, lanes]))
                at = at - widths[rows, lanes]

        def held(n: int) -> tuple[np.ndarray, np.ndarray]:
            return np.stack([w[1][:n] for w in window]), np.stack([w[2][:n] for w in window])

        for j in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(-sizes, -j))  # lanes with a character here
            here = text[source[:n] + j].astype(np.int64)
            piece, wide, score = np.full(n, -1, np.int32), np.zeros(n, np.int16), np.full(n, -np.inf) if unigram else None
            arcs = self._arcs(here, [w[0] for w in window[: min(j, size - 1)]])
            step, done = next(arcs), np.zeros(n, bool)
            try:
                while True:
                    back, rows, some, _ = step
                    if unigram:
                        value = (window[back][3][rows] if back < j else 0.0) + np.where(some < self.n_names, self.scores[np.minimum(some, self.n_names - 1)], self.model.floor)
                        good = value >= score[rows]
                        score[rows[good]] = value[good]
                    else:
                        good = self._follows(window[back][1][rows] if back < j else np.full(len(rows), self.start), some)
                    piece[rows[good]], wide[rows[good]] = some[good], back + 1
                    done[rows[good]] = not unigram
                    step = arcs.send(done)
            except StopIteration:
                pass
            if (piece < 0).any():
                raise ValueError("the model's merges leave a text without a segmentation")
            window.insert(0, (here, piece, wide, score))
            upto = j + 1
            self.widest = max(self.widest, len(window))
            if upto == self.overlap and inner[:n].any():
                last = np.stack([w[1][:n] for w in window[:size]])
                marks |= {k: last[:, k] for k in np.flatnonzero(inner[:n]).tolist()}
            ending = np.arange(int(np.searchsorted(-sizes, -upto)), n)
            if len(ending):
                pieces, widths = held(n)
                loose = unfinished[ending]
                for k in ending[loose].tolist():
                    tails[k] = (pieces[:, k], widths[:, k], int(base[k]), upto)
                trace(ending[~loose], np.full(int((~loose).sum()), len(pieces)), upto, pieces, widths)
                n = int(ending[0])
            if n and len(window) >= 2 * size:
                pieces, widths = held(n)
                deep = len(pieces)
                floor = base[:n] - (upto - deep)
                heads = np.zeros((deep + 1, n), bool)
                for at in range(deep - size + 1, deep + 1):
                    heads[at] = at >= floor
                count = heads.sum(0)
                for at in range(deep, 0, -1):
                    lanes = np.flatnonzero(heads[at] & (count > 1))
                    if len(lanes):
                        to = at - widths[deep - at, lanes]
                        heads[at, lanes] = False
                        count[lanes] -= heads[to, lanes]
                        heads[to, lanes] = True
                meet = heads.argmax(0)
                trace(np.arange(n), meet, upto, pieces, widths)
                base[:n] = np.maximum(base[:n], meet + (upto - deep))
                window = window[: max(size, upto - int(base[:n].min()))]
        if not out:
            out.append((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)))
        lanes, at, ids = (np.concatenate(x) for x in zip(*out))
        mine = order[lanes]
        at = at + source[lanes]
        sort = np.lexsort((at, mine))
        at, ids, special = at[sort], ids[sort], {}
        if known:
            bounds = np.searchsorted(mine[sort], np.arange(len(order) + 1)).tolist()
            for k, i in enumerate(order.tolist()):
                tail = tails.get(k)
                special[i] = (slice(bounds[i], bounds[i + 1]), tail[0][:size] if tail else None, marks.get(k), _rest(int(source[k]), *tail) if tail else None)
        return at, ids, special

    def expand(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become the ids of their bytes, or the unknown one."""
        lost = np.flatnonzero(ids >= self.n_names)
        if not len(lost):
            return ids.astype(np.uint32), counts
        odd, which = np.unique(ids[lost], return_inverse=True)
        spelled = [self.model.piece_ids(chr(c - self.n_names)) for c in odd.tolist()]
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        wide = np.ones(len(ids), np.int64)
        wide[lost] = sizes[which]
        out = np.repeat(ids, wide).astype(np.uint32)
        places = ranges(np.arange(len(out)), (np.cumsum(wide) - wide)[lost], wide[lost])
        out[places] = ranges(np.array([i for own in spelled for i in own], np.uint32), (np.cumsum(sizes) - sizes)[which], sizes[which])
        owner = np.repeat(np.arange(len(counts)), counts)
        return out, np.bincount(owner, weights=wide, minlength=len(counts)).astype(np.int64)


def _rest(first: int, pieces: np.ndarray, widths: np.ndarray, base: int, upto: int) -> Callable[[int], tuple[list[int], list[int]]]:
    """The pieces that an unfinished lane from ``first`` on has not given out, for the place where the next lane's path enters."""

    def path(entry: int) -> tuple[list[int], list[int]]:
        at, ends, ids = entry - first, [], []
        while at > base:
            row = upto - at
            ends.append(at + first)
            ids.append(int(pieces[row]))
            at -= int(widths[row])
        return ends[::-1], ids[::-1]

    return path


class PieceCoder:
    """Encodes whole texts; the distinct parts of a batch are solved once."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.lattice = WindowLattice(self.model)

    def _chunks(self, texts: list[str]) -> Chunks:
        """The texts, with their word marks, cut where all paths converge."""
        if self.model.splits and self.model.prefix:
            return spaced_of(texts)
        return Chunks(pa.array([self.model.prefix + t for t in texts], pa.large_string()), np.arange(len(texts)), np.array([bool(t) for t in texts], np.int64))

    def _solve(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts and their number for each."""
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(parts)], parts), pa.scalar("", parts.type))[0].as_py()
        lengths = pc.utf8_length(parts).to_numpy().astype(np.int64)
        return self.lattice.expand(*self.lattice.segment(np.frombuffer(joined.encode("utf-32-le"), np.uint32), lengths))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        chunks = self._chunks([t.replace(WORD_MARK, " ") for t in texts])  # one and the same to the model
        parts = pc.replace_substring(chunks.distinct, " ", WORD_MARK)
        if self.model.splits and self.model.prefix:
            parts = pc.binary_join_element_wise(pa.scalar(WORD_MARK, parts.type), parts, pa.scalar("", parts.type))
        flat, ends = chunks.gather(*self._solve(parts))
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


@lru_cache(maxsize=4)
def piece_coder(path: str) -> PieceCoder:
    return PieceCoder(path)


def _apply(docs: DataFrame, model: str, with_ids: bool) -> DataFrame:
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(model)
        names = coder.model.names
        unlike = np.array([k != NORMAL for k in coder.model.kinds])
        for batch, texts in grouped(batches, "text"):
            rows = coder.encode(texts)
            restored = []
            for text, ids in zip(texts, rows):
                listed = ids.tolist()
                whole = coder.model.decode(listed) if unlike[ids].any() else "".join(map(names.__getitem__, listed)).replace(WORD_MARK, " ")[1 if coder.model.prefix else 0 :]
                restored.append(whole == text.replace(WORD_MARK, " "))
            arrays = [
                batch.column(batch.schema.get_field_index("doc_id")),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([len(r) for r in rows], pa.int64()),
                pa.array([zlib.crc32(r.astype("<u4").tobytes()) for r in rows], pa.int64()),
                pa.array(restored),
            ]
            fields = ["doc_id", "n_chars", "n_tokens", "ids_crc32", "decoded"]
            if with_ids:
                arrays.append(pa.array([r.tolist() for r in rows], pa.list_(pa.int32())))
                fields.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, fields)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))


def encode_and_check(docs: DataFrame, model: str) -> DataFrame:
    """Encode every whole text, decode the ids again and report both.

    Per row: doc_id, n_chars, n_tokens, ids_crc32 (of the ids as little-endian 32-bit
    integers), decoded (the ids give the text back; a U+2581 in a text counts as the
    space it stands for). Defined cases: null and empty texts have no ids; repeated
    rows are encoded one by one; an empty table gives no rows; other columns are ignored.
    """
    return _apply(docs, model, False)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """As ``encode_and_check``, with the ids."""
    return _apply(docs, model, True)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); null ids give a null text."""
    ship_package(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(model)
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index("ids")).to_pylist()
            texts = [None if r is None else coder.model.decode(r) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.selectExpr("cast(doc_id as long) doc_id", "ids").mapInArrow(run, "doc_id long, text string")
