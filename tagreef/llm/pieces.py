"""SentencePiece encoding and decoding: batched Viterbi with numpy.

A text is cut before each run of blanks; the distinct cuts of a batch, sorted by
length, advance together, one position at a time. Substring hashes of all of
them probe the sorted keys of the pieces, length by length; the best way to
every position is a maximum over the pieces that end there, kept as a
back-pointer.

A BPE model's scores are the order of its merges and do not add up. What they say
of a way to cut a text is whether merging would ever cross one of its borders: the
right cut is the one all of whose neighbours stay apart when their characters are
merged by themselves. So a step of the Viterbi pass is open from one piece to the
next only if the two stay apart (:meth:`PieceModel.apart`), and every position is
reached by one open way, the library's own encoding of the text up to there.
Ids equal those of the model's own library. A character without a piece of its
own becomes the byte pieces of its UTF-8 form.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tagreef.llm.tables import sent
from tagreef.llm.words import INVERSE, BASE, mixed, pieces as text_pieces, powers, span_sums, spans_of

#: Bytes of text whose distinct words are worked out together.
GROUP_BYTES = 1 << 20
#: Ids decoded together, unless one text has more.
DECODED = 1 << 17
#: Most cells (words x positions x piece lengths) of one matrix, unless one word has more.
CELLS = 1 << 20
#: Pairs of pieces whose answer is kept.
KNOWN = 1 << 20
#: Bits of a key's head.
HEAD = 18

BLANK, MARK = 0x20, 0x2581
#: Stands for a mark that the text itself holds; no piece has it.
OWN_MARK = 0x110000


def _codes(points: np.ndarray) -> np.ndarray:
    return mixed(points.astype(np.uint64) + np.uint64(0x51ED27))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def merged(text: str, rank: dict[str, int]) -> tuple[list[str], list[tuple[int, str, str]]]:
    """A text's pieces by merging the best neighbours, of equal ones the first, and the merges made."""
    parts, made = list(text), []
    while True:
        ways = [(rank[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank]
        if not ways:
            return parts, made
        order, k = min(ways)
        made.append((order, parts[k], parts[k + 1]))
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


@dataclass
class PieceModel:
    """Piece keys by length, how pieces are merged, and what every id decodes to.

    ``rank`` orders the merges (-1: a character), ``first`` and ``last`` are the two
    pieces that were merged last into a piece; ``pairs`` are the sorted keys of all
    two neighbours that make up a piece, ``made`` the piece.
    """

    keys: dict[int, np.ndarray]
    ids: dict[int, np.ndarray]
    byte_ids: np.ndarray
    rank: np.ndarray
    first: np.ndarray
    last: np.ndarray
    pairs: np.ndarray
    made: np.ndarray
    decoded: np.ndarray
    offsets: np.ndarray
    # Made by the first use, not sent along: answers of ``apart``, and by length the
    # heads of the keys, which rule most substrings out without a search.
    known: np.ndarray | None = None
    answer: np.ndarray | None = None
    heads: dict[int, np.ndarray] | None = None

    @classmethod
    def load(cls, file: str) -> "PieceModel":
        """Read a BPE ``.model`` file with byte fallback and no normalisation of its own.

        Any other model is refused: one that lowers, folds or trims texts, one without
        byte pieces, one with a piece across words, and one whose scores are not an
        order of merges (a unigram model), since then a piece's own characters would
        not merge into it step by step.
        """
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=file)
        probe = "\ufb01  \uff21 \u0041\u030a "
        if model.decode(model.encode(probe)) != probe:
            raise ValueError("the model changes texts before it cuts them")
        size = model.get_piece_size()
        byte_ids, words, out = np.full(256, -1, np.int32), {}, []
        for k in range(size):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                byte_ids[int(piece[1:-1], 16)] = k
                out.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                out.append(b"")
            else:
                if "▁" in piece.lstrip("▁"):
                    raise ValueError(f"a piece runs across words: {piece!r}")
                words[piece.replace("▁", " ")] = k
                out.append(piece.replace("▁", " ").encode())
        if (byte_ids < 0).any():
            raise ValueError("the model has no byte pieces")
        # Characters that only occur inside pieces get ids beyond the model's.
        ids = words | {c: size + n for n, c in enumerate(sorted({c for w in words for c in w} - set(words)))}
        order = {w: int(-model.get_score(k)) for w, k in words.items() if len(w) > 1}
        rank, first, last = (np.full(len(ids) + size + 1, -1, np.int64) for _ in range(3))
        for word in order:
            parts, made = merged(word, order)
            steps = [m[0] for m in made]
            if len(parts) > 1 or steps != sorted(steps):
                raise ValueError(f"the model's scores are no order of merges: {word!r}")
            _, left, right = made[-1]
            rank[ids[word]], first[ids[word]], last[ids[word]] = order[word], ids[left], ids[right]
        made = {
            (ids[w[:k]], ids[w[k:]]): ids[w] for w in order for k in range(1, len(w)) if w[:k] in ids and w[k:] in ids
        }
        pairs = np.array([a << 32 | b for a, b in made], np.int64)
        order_of_pairs = np.argsort(pairs)
        keys, by_length = {}, {}
        for length in {len(w) for w in ids}:
            rows = [(w, k) for w, k in ids.items() if len(w) == length]
            points = np.concatenate([_codes(_points(w)) for w, _ in rows])
            begin = np.arange(len(rows)) * length
            key = span_sums(points, begin, begin + length)
            sort = np.argsort(key)
            keys[length] = key[sort]
            by_length[length] = np.array([k for _, k in rows], np.int32)[sort]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])])
        return cls(
            keys, by_length, byte_ids, rank, first, last, pairs[order_of_pairs],
            np.fromiter(made.values(), np.int64, len(made))[order_of_pairs], np.frombuffer(b"".join(out), np.uint8), offsets,
        )

    def _prepare(self) -> None:
        if self.known is None:
            self.known, self.answer = np.full(KNOWN, -1, np.int64), np.zeros(KNOWN, bool)
            self.heads = {size: np.zeros(1 << HEAD, bool) for size in self.keys}
            for size, keys in self.keys.items():
                self.heads[size][keys >> np.uint64(64 - HEAD)] = True

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the characters of two neighbouring pieces, merged by themselves, end as these two.

        Answers are kept by the pair's hash, the latest in the place of an older one.
        """
        self._prepare()
        key = left.astype(np.int64) << 32 | right
        slot = (mixed(key.astype(np.uint64)) >> np.uint64(44)).astype(np.int64) % len(self.known)
        out = self.answer[slot]
        new = np.flatnonzero(self.known[slot] != key)
        if len(new):
            fresh, which = np.unique(key[new], return_inverse=True)
            out[new] = self._apart(fresh >> 32, fresh & 0xFFFFFFFF)[which]
            self.known[slot[new]] = key[new]
            self.answer[slot[new]] = out[new]
        return out

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Undo the merges on both sides of each border, the latest first.

        At every stage the two pieces at the border would have merged, had their own
        piece come before the merge that is undone next; of equal ones the one further
        left comes first. ``bar`` is twice the order of that merge, plus one if it is
        on the right.
        """
        out = np.ones(len(left), bool)
        live = np.arange(len(left))
        left, right = left.copy(), right.copy()
        bar = np.full(len(left), np.iinfo(np.int64).max)
        while len(live):
            pair = left << 32 | right
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            crossed = (self.pairs[at] == pair) & (2 * self.rank[self.made[at]] < bar)
            out[live[crossed]] = False
            a, b = self.rank[left], self.rank[right]
            more = ~crossed & (np.maximum(a, b) >= 0)
            live, left, right, a, b = live[more], left[more], right[more], a[more], b[more]
            later = b >= a
            bar = np.where(later, 2 * b + 1, 2 * a)
            left, right = np.where(later, left, self.last[left]), np.where(later, self.first[right], right)
        return out

    def _cut(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place, id) of the pieces of each row of equally long words, in order.

        A character that needs its bytes has the id -1.
        """
        n, length = points.shape
        self._prepare()
        longest = min(length, max(self.keys))
        values = _codes(points.ravel()).reshape(n, length)
        sums = np.zeros((n, length + 1), np.uint64)
        np.cumsum(values * powers(BASE, length)[:length], axis=1, out=sums[:, 1:])
        back = powers(INVERSE, length)[:length]
        # piece[j, :, d]: of the substring of d + 1 characters that ends with j.
        piece = np.full((length, n, longest), -1, np.int32)
        strange = len(self.rank) - 1  # a character that no piece holds
        piece[:, :, 0] = strange
        for size in range(1, longest + 1):
            if size not in self.keys:
                continue
            keys = mixed((sums[:, size:] - sums[:, :-size]) * back[: length - size + 1] + np.uint64(size)).T
            end, word = np.nonzero(self.heads[size][keys >> np.uint64(64 - HEAD)])
            keys = keys[end, word]
            at = np.minimum(np.searchsorted(self.keys[size], keys), len(self.keys[size]) - 1)
            hit = self.keys[size][at] == keys
            piece[end[hit] + size - 1, word[hit], size - 1] = self.ids[size][at[hit]]
        ends, row, size = np.nonzero(piece >= 0)
        edges = np.searchsorted(ends, np.arange(length + 1)).tolist()
        ids = piece[ends, row, size].astype(np.int64)
        size += 1
        # The last piece of the way to each position, and its length.
        latest = np.full((length + 1, n), -1, np.int64)
        taken = np.zeros((length, n), np.int32)
        for j in range(length):
            a, b = edges[j], edges[j + 1]
            word, width, last = row[a:b], size[a:b], ids[a:b]
            before = latest[j + 1 - width, word]
            open_ = before < 0
            rest = np.flatnonzero(~open_)
            open_[rest] = self.apart(before[rest], last[rest])
            # Sorted by length within a word, so the greatest length is written last.
            latest[j + 1, word[open_]] = last[open_]
            taken[j, word[open_]] = width[open_]
        place = np.full(n, length)
        at, live = [], np.arange(n)
        while len(live):
            width = taken[place[live] - 1, live]
            place[live] -= width
            at.append((live, place[live].copy(), width))
            live = live[place[live] > 0]
        row, start, size = (np.concatenate(x) for x in zip(*at))
        order = np.lexsort((start, row))
        row, start, size = row[order], start[order], size[order]
        found = latest[start + size, row]
        return row, start, np.where(found < len(self.offsets) - 1, found, -1).astype(np.int32)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All piece ids, and where each text's begin; nothing for a null or empty text."""
        whole = "".join([" " + t for t in texts if t])
        lengths = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        cuts = np.concatenate([[0], np.cumsum(lengths)])
        if not len(whole):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        points = _points(whole).copy()
        points[points == MARK] = OWN_MARK
        blank = points == BLANK
        begin = blank.copy()
        begin[1:] &= ~blank[:-1]
        begin[cuts[:-1][lengths > 0]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(points))
        hashes = span_sums(_codes(points), starts, ends)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        size = (ends - starts)[first]
        order = np.argsort(size, kind="stable")
        flat, counts, total = [], np.zeros(len(first), np.int64), 0
        offset = np.zeros(len(first), np.int64)
        bounds = np.flatnonzero(np.diff(size[order], prepend=-1)).tolist()
        for low, high in zip(bounds, [*bounds[1:], len(order)]):
            length = int(size[order[low]])
            step = max(1, CELLS // (length * min(length, max(self.keys))))
            for a in range(low, high, step):
                words = order[a : min(a + step, high)]
                chars = points[starts[first[words]][:, None] + np.arange(length)]
                row, place, ids = self._cut(chars)
                ids, per = self._with_bytes(ids, chars[row, place], row, len(words))
                offset[words], counts[words] = total + np.cumsum(per) - per, per
                total += len(ids)
                flat.append(ids)
        ids = np.concatenate(flat)
        per_word = counts[which]
        out = ids[np.repeat(offset[which], per_word) + spans_of(per_word)]
        ids_before = np.concatenate([[0], np.cumsum(per_word)])
        return out, ids_before[np.searchsorted(starts, cuts)]

    def _with_bytes(self, ids: np.ndarray, chars: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Byte pieces in place of -1, and the number of pieces of each row."""
        bare = np.flatnonzero(ids < 0)
        if len(bare):
            kinds, which = np.unique(chars[bare], return_inverse=True)
            raw = [self.byte_ids[list(chr(MARK if c == OWN_MARK else c).encode())] for c in kinds.tolist()]
            times = np.ones(len(ids), np.int64)
            times[bare] = np.array([len(r) for r in raw])[which]
            row, ids = np.repeat(row, times), np.repeat(ids, times)
            ids[ids < 0] = np.concatenate([raw[k] for k in which.tolist()])
        return ids, np.bincount(row, minlength=n)

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> list[str]:
        """The texts of runs of ids, without the blank that encoding puts in front."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.offsets) - 1:
            raise ValueError("an id that the model does not have")
        sizes = np.diff(self.offsets)[ids]
        raw = self.decoded[np.repeat(self.offsets[ids], sizes) + spans_of(sizes)].tobytes()
        bounds = np.concatenate([[0], np.cumsum(sizes)])[cuts].tolist()
        out = [raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]
        return [t[1:] if t.startswith(" ") else t for t in out]


def _grown(docs: DataFrame, name: str, kind: T.DataType) -> tuple[list[str], T.StructType]:
    kept = [c for c in docs.columns if c != name]
    return kept, T.StructType([*docs.select(*kept).schema.fields, T.StructField(name, kind)])


def encode_texts(docs: DataFrame, model_file: str, text: str = "text", name: str = "ids") -> DataFrame:
    """Every row of ``docs`` with the piece ids of ``text`` in ``name``.

    Decoding gives back the text exactly, whatever its blanks, line ends, marks
    or characters. A null text has null ids, an empty one none. An input column
    called ``name`` is replaced. The model (its file is read by the driver) has a
    fixed size and goes to the executors as a broadcast.
    """
    model = sent(docs.sparkSession, PieceModel.load(model_file))
    kept, schema = _grown(docs, name, T.ArrayType(T.IntegerType()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model()
        for batch in batches:
            column = batch.column(text)
            for low, high, _, _ in text_pieces(column, GROUP_BYTES):
                part = column[low:high]
                ids, cuts = pieces.encode(part.to_pylist())
                found = pa.ListArray.from_arrays(
                    pa.array(cuts.astype(np.int32)), pa.array(ids), mask=part.is_null()
                )
                yield pa.RecordBatch.from_arrays([*(batch.column(c)[low:high] for c in kept), found], [*kept, name])

    return docs.select(*kept, *([] if text in kept else [text])).mapInArrow(encode, schema)


def decode_ids(docs: DataFrame, model_file: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """Every row of ``docs`` with the text of its piece ids in ``name``; null for null ids.

    Null ids within a list say nothing; ids that the model does not have are an
    error. Bytes that are not UTF-8 become replacement characters.
    """
    model = sent(docs.sparkSession, PieceModel.load(model_file))
    kept, schema = _grown(docs, name, T.StringType())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model()
        for batch in batches:
            column = batch.column(ids)
            ends = np.cumsum(np.asarray(column.value_lengths().fill_null(0)).astype(np.int64))
            low = 0
            while low < len(batch):
                # Texts of about DECODED ids, so that memory does not grow with the batch.
                done = ends[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(ends, done + DECODED, "right")))
                lists = column[low:high]
                flat = np.asarray(lists.flatten().fill_null(0))
                texts = pieces.decode(flat, np.concatenate([[0], ends[low:high] - done]))
                found = pa.array(texts, pa.string(), mask=np.asarray(lists.is_null()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c)[low:high] for c in kept), found], [*kept, name])
                low = high

    return docs.mapInArrow(decode, schema)
