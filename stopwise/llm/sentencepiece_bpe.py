"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A batch's texts are cut into words (a run of meta spaces and what follows it; no piece crosses such a
border, which is checked when the model is loaded). Words that a task hasn't met lately are encoded
together: their symbols lie in one flat numpy array with a segment per word. Two neighbours that stand
side by side in no piece at all can never end in one piece, so segments are cut there, too, at the start and
after each merge: long words soon fall into many short segments, each of which goes on by itself. Each round
finds every segment's least pair rank, merges its occurrences from the left - all that don't overlap, up to
one whose new piece makes a pair of no later rank with a neighbour, and on if the cut behind it is final - for all segments at once, and compacts the arrays, until no pair is
left. Long runs of one character whose run pieces share a rank (the spaces) are closed in blocks of the
longest run. Symbols outside the vocabulary become their UTF-8 bytes' pieces.

The model file is only read, by the driver: vocabulary, ranks and flags come from its protobuf fields. Its path
is a parameter, and the table made of it travels to the tasks as a broadcast (some MB for 32,000 pieces).

Defined cases: a null text encodes like the empty one (end id only) and decodes to the empty text; null
ids decode to the empty text; very long texts and words are encoded whole, in rounds that split them further (a word that
repeats one reacting pattern without a final cut takes a round per repetition); repeated rows get the same ids; ties in rank go to the leftmost pair; an
empty table gives an empty result; ids outside the vocabulary raise an error; extra columns pass through,
input columns with the name of a result column are replaced.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_columns, table

SPACE = "▁"
_NO = np.int64(1) << 40
#: Ids of words remembered by a task.
_MEMO_TOKENS = 1_000_000
#: Characters of words that are encoded together (more only for one longer word).
_TOGETHER = 300_000


class Bpe:
    """The merge table of a BPE model with byte fallback and an identity normaliser."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        m = sentencepiece_model_pb2.ModelProto()
        m.ParseFromString(model)
        spec = m.normalizer_spec
        if m.trainer_spec.model_type != 2 or not m.trainer_spec.byte_fallback or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("a BPE model with byte fallback, escaped spaces and the identity normaliser is needed")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.pieces = [p.piece for p in m.pieces]
        kinds = [p.type for p in m.pieces]
        if any(k not in (1, 2, 3, 6) for k in kinds):
            raise ValueError("user-defined and unused pieces are not supported")
        self.n = len(self.pieces)
        self.eos = kinds.index(3) if "</s>" not in self.pieces else self.pieces.index("</s>")
        self.byte_id = np.zeros(256, np.int64)
        for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)):
            if k == 6:
                self.byte_id[int(p[3:5], 16)] = i
        normal = {p.piece: i for i, p in enumerate(m.pieces) if p.type == 1}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece holds a space after another character")
        # symbols: pieces first, then single characters that have no piece of their own
        self.symbol = dict(normal)
        for p in normal:
            for c in p:
                self.symbol.setdefault(c, self.n + len(self.symbol))
        # higher score first; equal scores (the runs of spaces) share a rank, and the leftmost pair goes first
        scores = sorted({-p.score for p in m.pieces if p.type == 1})
        place = {s: r for r, s in enumerate(scores)}
        self.rank = np.full(max(self.symbol.values()) + 1, _NO, np.int64)
        for p, i in normal.items():
            self.rank[i] = place[-m.pieces[i].score]
        #: pieces from which a merge of no later rank can be made: these are merged one at a time
        self.touchy = np.zeros(len(self.rank), bool)
        self.base = len(self.rank)
        #: for each two symbols that stand side by side in a piece: what they make (-1: only part of a piece)
        found: dict[int, int] = {}
        symbol, base = self.symbol, self.base
        for p, i in normal.items():
            cuts = range(len(p) + 1)
            for lo in cuts:
                for mid in cuts[lo + 1 :]:
                    left = symbol.get(p[lo:mid])
                    if left is None:
                        continue
                    for hi in cuts[mid + 1 :]:
                        right = symbol.get(p[mid:hi])
                        if right is None:
                            continue
                        key = left * base + right
                        if hi - lo < len(p):
                            found.setdefault(key, -1)
                            continue
                        found[key] = i
                        for part in (left, right):
                            if self.rank[part] >= self.rank[i]:
                                self.touchy[part] = True
        self.keys = np.fromiter(found, np.int64, len(found))
        order = np.argsort(self.keys)
        self.keys, self.made = self.keys[order], np.fromiter(found.values(), np.int64, len(found))[order]
        #: for characters whose runs are pieces of one rank and stand in no other piece: length and id of the run that closes (0: none)
        self.block = np.zeros(self.base, np.int64)
        self.block_id = np.zeros(self.base, np.int64)
        for c, i in symbol.items():
            holds = [p for p in normal if c * 2 in p] if len(c) == 1 and c * 2 in normal else []
            runs = {len(p) for p in holds} if not any(p.strip(c) for p in holds) else set()
            if runs and len({int(self.rank[normal[c * k]]) for k in runs}) == 1:
                most = max(runs)
                if self._first_of_run(runs, 3 * most) == most and not self._look(np.array([normal[c * most]]), np.array([i]))[1][0]:
                    self.block[i], self.block_id[i] = most, normal[c * most]
        control = {i for i, k in enumerate(kinds) if k in (2, 3)}
        self.raw = [b"" if i in control else bytes([int(p[3:5], 16)]) if kinds[i] == 6 else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.is_byte = np.array([k == 6 for k in kinds])
        self.control = control

    @staticmethod
    def _first_of_run(runs: set[int], n: int) -> int:
        """Length of the first piece of n equal characters if always the leftmost pair with a piece is merged."""
        parts = [1] * n
        while True:
            at = next((k for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in runs), None)
            if at is None:
                return parts[0]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What two neighbours make (-1: nothing), and whether any piece could ever cross their border."""
        key = np.where((a < self.base) & (b < self.base), a * self.base + b, -1)
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        live = self.keys[place] == key
        return np.where(live, self.made[place], -1), live

    def encode_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and each word's number of ids."""
        text = "".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        chars, where = np.unique(points, return_inverse=True)
        # characters without a symbol stand as base + code point until the end
        table_ = np.array([self.symbol.get(chr(c), self.base + int(c)) for c in chars], np.int64)
        sym, seg = table_[where] if len(chars) else np.zeros(0, np.int64), np.repeat(np.arange(len(words)), sizes)
        if not len(sym):
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        done_sym, done_seg, done_pos = [], [], []
        pos = np.arange(len(sym))
        made, live = self._look(sym, np.r_[sym[1:], self.base])
        head = np.r_[True, (seg[1:] != seg[:-1]) | ~live[:-1]]  # where segments start
        made[np.r_[head[1:], True]] = -1
        rank = np.where(made >= 0, self.rank[made], _NO)
        while len(sym):
            first = np.flatnonzero(head)
            least = np.minimum.reduceat(rank, first)
            length = np.diff(np.r_[first, len(head)])
            open_ = np.repeat(least < _NO, length)
            if not open_.all():  # segments without a pair are ready
                done_sym.append(sym[~open_])
                done_seg.append(seg[~open_])
                done_pos.append(pos[~open_])
                sym, seg, pos, head, made, rank = (x[open_] for x in (sym, seg, pos, head, made, rank))
                if not len(sym):
                    break
                keep = least < _NO
                least, length = least[keep], length[keep]
            at = np.flatnonzero(rank == np.repeat(least, length))
            part = (np.cumsum(head) - 1)[at]
            new = np.r_[True, part[1:] != part[:-1]]
            # in a row of overlapping hits every second one counts, from the left
            start = np.r_[True, (at[1:] != at[:-1] + 1) | new[1:]]
            row = np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
            even = (np.arange(len(at)) - row) % 2 == 0
            at, part = at[even], part[even]
            left = np.ones(len(sym), bool)
            touchy = self.touchy[made[at]]
            if touchy.any():
                at = self._in_turn(sym, head, made, at, part, touchy)
                if self.block.any():
                    at = self._close_runs(sym, head, made, rank, left, at)
            sym[at] = made[at]
            left[at + 1] = False
            moved = np.cumsum(left) - 1
            sym, seg, pos, head, made, rank = (x[left] for x in (sym, seg, pos, head, made, rank))
            # only the pairs that hold a new symbol change
            at = moved[at]
            near = np.concatenate([at, at[at > 0] - 1])
            after = np.minimum(near + 1, len(sym) - 1)
            new_made, live = self._look(sym[near], sym[after])
            live &= (after > near) & ~head[after]
            made[near] = np.where(live, new_made, -1)
            rank[near] = np.where(made[near] >= 0, self.rank[made[near]], _NO)
            head[after[~live & (after > near)]] = True
        sym, seg, pos = (np.concatenate(x) for x in (done_sym, done_seg, done_pos))
        order = np.argsort(pos, kind="stable")
        sym, seg = sym[order], seg[order]
        return self._bytes_for_rest(sym, seg, len(words))

    def _in_turn(self, sym: np.ndarray, head: np.ndarray, made: np.ndarray, at: np.ndarray, part: np.ndarray, touchy: np.ndarray) -> np.ndarray:
        """Of the hits, those that can be merged at once where pieces are touchy.

        From a segment's left up to the first whose new piece makes a pair of no later rank with a neighbour (that pair
        goes before the next hit), and on, if the cut behind that one is final.
        """
        piece, least = made[at], self.rank[made[at]]
        after = np.minimum(at + 2, len(sym) - 1)
        edge = (at + 2 >= len(sym)) | head[after]
        right, live = self._look(piece, sym[after])
        left = sym[at - 1]
        close = np.flatnonzero(at[1:] == at[:-1] + 2) + 1
        left[close] = piece[close - 1]  # the hit before is merged first
        right_of_left, _ = self._look(left, piece)
        rank = lambda made_, no: np.where(no | (made_ < 0), _NO, self.rank[made_])
        reacts = touchy & (np.minimum(rank(right, edge), rank(right_of_left, head[at])) <= least)
        stop = reacts & live & ~edge
        stops = np.cumsum(stop) - stop  # those before a hit
        first = np.r_[True, part[1:] != part[:-1]]
        before = stops[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        return at[stops == before]

    def _close_runs(self, sym: np.ndarray, head: np.ndarray, made: np.ndarray, rank: np.ndarray, left: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Close all full blocks of the runs of one character that hits start, but for the run's end. Returns the other hits."""
        mine = np.flatnonzero((self.block[np.minimum(sym[at], self.base - 1)] > 0) & (sym[at] < self.base) & (sym[at] == sym[np.minimum(at + 1, len(sym) - 1)]))
        if not len(mine):
            return at
        border = np.flatnonzero(head | np.r_[True, sym[1:] != sym[:-1]])
        end = np.r_[border, len(sym)][np.searchsorted(border, at[mine], "right")]
        size = self.block[sym[at[mine]]]
        blocks = (end - at[mine] - 1) // size
        mine, size, blocks = (x[blocks > 0] for x in (mine, size, blocks))
        if not len(mine):
            return at
        flat = lambda w: np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        starts = np.repeat(at[mine], blocks) + flat(blocks) * np.repeat(size, blocks)
        width = np.repeat(size, blocks)
        whole = np.repeat(starts, width) + flat(width)
        left[whole] = False
        left[starts] = True
        sym[starts] = self.block_id[sym[starts]]
        made[starts], rank[starts] = -1, _NO
        head[starts], head[starts + width] = True, True
        before = at[mine] - 1
        before = before[(before >= 0)]
        made[before], rank[before] = np.where(head[before + 1], -1, made[before]), np.where(head[before + 1], _NO, rank[before])
        return np.delete(at, mine)

    def _bytes_for_rest(self, sym: np.ndarray, seg: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols without a piece become the pieces of their UTF-8 bytes."""
        odd = np.flatnonzero(sym >= self.n)
        if len(odd):
            inverse = {v: k for k, v in self.symbol.items() if v >= self.n}
            kinds, back = np.unique(sym[odd], return_inverse=True)
            raw = [(inverse[k] if k < self.base else chr(k - self.base)).encode("utf-8", "surrogatepass") for k in kinds.tolist()]
            width = np.ones(len(sym), np.int64)
            width[odd] = np.array([len(x) for x in raw])[back]
            out, at = np.repeat(sym, width), np.cumsum(width) - width
            starts, w = at[odd], width[odd]
            flat = np.repeat(starts, w) + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            lens = np.array([len(x) for x in raw])
            base = np.repeat((np.cumsum(lens) - lens)[back], w) + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            out[flat] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)[base]]
            return out, np.bincount(np.repeat(seg, width), minlength=n)
        return sym, np.bincount(seg, minlength=n)


def _portions(words: Sequence[str]) -> list[Sequence[str]]:
    """Words in runs of about _TOGETHER characters, which bounds the arrays of a round."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    cuts = [0, *(np.flatnonzero(np.diff(ends // _TOGETHER)) + 1).tolist(), len(words)]
    return [words[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Encoder:
    """Encodes batches; remembers words, in a table bounded by its number of ids."""

    def __init__(self, bpe: Bpe) -> None:
        self.bpe = bpe
        self._clear()

    def _clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.flat: list[np.ndarray] = []
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def words(self, text: str | None) -> list[str]:
        """The text after normalising, cut before each run of meta spaces."""
        if not text:
            return []
        parts = (self.bpe.prefix + text.replace(" ", SPACE)).split(SPACE)
        if "" not in parts[1:]:
            return [SPACE + p for p in parts[1:]] if not parts[0] else [parts[0], *[SPACE + p for p in parts[1:]]]
        out, run = [parts[0]] if parts[0] else [], 0
        for p in parts[1:]:
            run += 1
            if p:
                out.append(SPACE * run + p)
                run = 0
        return [*out, SPACE * run] if run else out

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each with the end id, and offsets (one more than texts)."""
        if len(self.ids) > _MEMO_TOKENS:
            self._clear()
        cut = [self.words(t) for t in texts]
        memo = self.memo
        fresh = list(set().union(*cut).difference(memo))
        if fresh:
            done = [self.bpe.encode_words(part) for part in _portions(fresh)]
            ids, counts = (np.concatenate(x) for x in zip(*done, strict=True))
            for w in fresh:
                memo[w] = len(memo)
            self.start = np.r_[self.start, len(self.ids) + np.cumsum(counts) - counts]
            self.count = np.r_[self.count, counts]
            self.ids = np.r_[self.ids, ids.astype(np.int32)]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        w = np.fromiter(map(memo.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        n = self.count[w]
        tokens = np.concatenate([[0], np.cumsum(n)])
        ends = tokens[np.cumsum(sizes)] if len(sizes) else np.zeros(0, np.int64)
        body = self.ids[np.repeat(self.start[w] - tokens[:-1], n) + np.arange(tokens[-1])]
        out = np.insert(body, ends, self.bpe.eos).astype(np.int32)
        return out, np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])


class Decoder:
    def __init__(self, bpe: Bpe) -> None:
        self.bpe = bpe
        self.size = np.fromiter(map(len, bpe.raw), np.int64, bpe.n)
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(bpe.raw), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of ids, bytes first; the space that encoding put in front goes."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.bpe.n):
            raise ValueError("an id is outside the vocabulary")
        n = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(n)])
        raw = self.data[np.repeat(self.at[ids] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
        cuts = ends[offsets].tolist()
        out = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = raw[a:b]
            out.append(_text(part[1:] if self.bpe.prefix and part[:1] == b" " else part))
        return out


def _text(raw: bytes) -> str:
    """Bytes that are no UTF-8 become a replacement character each."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out = []
        while raw:
            try:
                out.append(raw.decode())
                break
            except UnicodeDecodeError as e:
                out += [raw[: e.start].decode(), "�"]
                raw = raw[e.start + 1 :]
        return "".join(out)


@functools.lru_cache(maxsize=4)
def _load(model_path: str, changed: int) -> Bpe:
    with open(model_path, "rb") as f:
        return Bpe(f.read())


def load(model_path: str) -> Bpe:
    """The merge table of a model file (kept while the file is the same)."""
    return _load(model_path, os.stat(model_path).st_mtime_ns)


def _shared(df: DataFrame, model_path: str):
    return df.sparkSession.sparkContext.broadcast(load(model_path))


def encode(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", keep: Sequence[str] | None = None) -> DataFrame:
    """Append the ids of each whole text, the end id last. model_path: a file that the driver can read."""
    shared = _shared(df, model_path)

    def make():
        enc = Encoder(shared.value)

        def f(texts: pa.Array) -> list[pa.Array]:
            ids, offsets = enc.encode(texts.to_pylist())
            return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]

        return f

    return add_columns(df, [T.StructField(ids_col, T.ArrayType(T.IntegerType()))], [text_col], make, keep)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded", keep: Sequence[str] | None = None) -> DataFrame:
    """Append the text of each row's ids."""
    shared = _shared(df, model_path)

    def make():
        dec = Decoder(shared.value)

        def f(ids: pa.Array) -> list[pa.Array]:
            full = ids.fill_null([]) if ids.null_count else ids
            offsets = full.offsets.to_numpy().astype(np.int64)
            flat = full.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64)
            return [pa.array(dec.decode(flat, offsets - offsets[0]), pa.string())]

        return f

    return add_columns(df, [T.StructField(text_col, T.StringType())], [ids_col], make, keep)


def encode_decode(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded", keep: Sequence[str] | None = None) -> DataFrame:
    """Append the ids of each whole text and the text that they decode to, in one pass (one Python worker a task)."""
    shared = _shared(df, model_path)

    def make():
        bpe: Bpe = shared.value
        enc, dec = Encoder(bpe), Decoder(bpe)

        def f(texts: pa.Array) -> list[pa.Array]:
            ids, offsets = enc.encode(texts.to_pylist())
            return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)), pa.array(dec.decode(ids, offsets), pa.string())]

        return f

    fields = [T.StructField(ids_col, T.ArrayType(T.IntegerType())), T.StructField(decoded_col, T.StringType())]
    return add_columns(df, fields, [text_col], make, keep)


def round_trip(df: DataFrame, model_path: str, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Append n_tokens, ids_sha256 and decoded_sha256: encode, then decode those ids, in one pass."""
    shared = _shared(df, model_path)

    def make():
        bpe: Bpe = shared.value
        enc, dec = Encoder(bpe), Decoder(bpe)
        digits = [str(i) for i in range(bpe.n)]

        def f(texts: pa.Array) -> list[pa.Array]:
            ids, offsets = enc.encode(texts.to_pylist())
            decoded = dec.decode(ids, offsets)
            cuts = offsets.tolist()
            sha = [hashlib.sha256(" ".join(map(digits.__getitem__, ids[a:b].tolist())).encode()).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            back = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in decoded]
            return [pa.array(np.diff(offsets)), pa.array(sha), pa.array(back)]

        return f

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return add_columns(df, fields, [text_col], make, keep)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op3_sentencepiece(spark, sf_dir: str, model_path: str | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, model_path or default_model(), keep=["doc_id"]).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
