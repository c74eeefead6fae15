"""Encoding a corpus with a public byte-level BPE vocabulary: a bounded-lookahead streaming transducer.

The text is cut into pieces by the vocabulary's pattern, chunk by chunk; a piece becomes tokens in the
transducer, which reads it byte by byte from left to right:

* For every prefix of a piece the *last token* of its encoding is unique, and a sequence of tokens is the
  encoding of its bytes exactly if every two neighbours are the encoding of theirs. So the last token at a
  position is found from the tokens that end there and the last token where each of them begins.
* ``sufficient_lookahead`` computes from the merge list how many bytes behind a token can still change it: a
  merge can be taken away from a token only by an earlier-ranked merge of its right edge with what follows, whose
  right part can in turn be taken away by a still earlier one, and so on; ranks fall along such a chain, so its
  longest byte length is found by going through the merges once in rank order.
* A token with that many bytes read behind it is stable and is emitted, and the positions before it are
  forgotten: the state is bounded by the lookahead plus the longest token, however long the text is.

``StreamingEncoder`` carries the state over chunks of a text, ``StreamingDecoder`` turns ids into text
incrementally, holding back the bytes of an unfinished character.

Pieces of the vocabulary are their own token; what the transducer gave for other short pieces is remembered in a
bounded table per Python worker. The vocabulary file is read on the driver and travels to the workers as one
broadcast of its bytes (below 1 MB), so executors need no such file.

Defined results: null and empty texts both give the empty list; special-token strings are ordinary text; texts of
any length are encoded whole; repeated rows are encoded as often as they come; other columns are left alone.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

#: Cut of a text into pieces (fixed value, part of the public vocabulary's definition).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CHUNK = 1 << 16  # characters scanned at once
REMEMBERED = 1 << 18  # pieces remembered per worker
SHORT = 64  # characters of a piece that may be remembered
BEGINNING = 7  # bytes of a piece whose state is remembered


class Vocabulary:
    """Ranks of the tokens with the merge that makes each of them."""

    def __init__(self, data: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        self.longest = max(map(len, self.ranks))
        self._lengths: dict[bytes, list[int]] | None = None
        self._edges: dict[tuple[bytes, int], list[tuple[bytes, float]]] = {}
        self._halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._lookahead: int | None = None

    def merge(self, piece: bytes, below: int | None = None) -> list[bytes]:
        """The encoding of a short piece by the definition: merge the pair of lowest rank, leftmost first.

        below: only merges of a lower rank."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes this one; None for single bytes and tokens no merge can make."""
        if token not in self._halves:
            parts = self.merge(token, self.ranks[token]) if len(token) > 1 else []
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The parts that lie at a token's left (0) or right (1) edge while it is made, each with the rank that ends it."""
        key = token, side
        got = self._edges.get(key)
        if got is None:
            got, until = [], float("inf")
            part = token
            while part:
                got.append((part, until))
                half = self.halves(part)
                until = self.ranks[part]
                part = half[side] if half else b""
            self._edges[key] = got
        return got

    def fits(self, left: bytes, right: bytes) -> bool:
        """Whether the two are the encoding of their concatenation: no merge across their border comes first.

        A merge across the border takes place while both its parts are there; of equal ranks the one further left does.
        """
        get = self.ranks.get
        ys = self._edge(right, 0)
        for x, x_until in self._edge(left, 1):
            for y, y_until in ys:
                rank = get(x + y)
                if rank is not None and rank < x_until and rank <= y_until:
                    return False
        return True

    def ending(self, end: bytes) -> list[int]:
        """Lengths of the tokens that end in these (up to) two bytes, longest first."""
        if self._lengths is None:
            by: dict[bytes, set[int]] = {}
            for t in self.ranks:
                by.setdefault(t[-2:], set()).add(len(t))
                by.setdefault(t[-1:], set()).add(1)
            self._lengths = {k: sorted(v | {1}, reverse=True) for k, v in by.items()}
        return self._lengths.get(end, [1])

    def sufficient_lookahead(self) -> int:
        """Bytes after a token's end that can still change it, at most."""
        if self._lookahead is None:
            starts: dict[bytes, tuple[list[int], list[int]]] = {}  # token -> ranks of merges that begin with it, running maxima of their reach

            def reach(token: bytes, below: int) -> int:
                ranks, most = starts.get(token, ((), ()))
                k = bisect_left(ranks, below)
                return most[k - 1] if k else 0

            def edge(token: bytes, below: int) -> int:
                """Reach over the right edge of a token that itself is merged away at rank `below`."""
                far = reach(token, below)
                while half := self.halves(token):
                    below, token = self.ranks[token], half[1]
                    far = max(far, reach(token, below))
                return far

            worst = 0
            for token, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
                if half := self.halves(token):
                    far = len(half[1]) + edge(half[1], rank)
                    ranks, most = starts.setdefault(half[0], ([], []))
                    ranks.append(rank)
                    most.append(max(far, most[-1] if most else 0))
            top = len(self.ranks)
            for token in self.ranks:
                worst = max(worst, edge(token, top))
            self._lookahead = worst
        return self._lookahead


class Transducer:
    """Bytes of one piece in, ids out; keeps no more than the lookahead and the longest token."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.keep = vocabulary.longest
        self.begun: dict[bytes, list[int]] = {}
        self.reset()

    def reset(self) -> None:
        self.window = b""  # bytes from `base` on
        self.base = 0  # position of the window's first byte in the piece; a token begins there
        self.last: list[int] = [0]  # length of the last token of the encoding up to base + i

    def _extend(self, data: bytes) -> None:
        window, last, v = self.window + data, self.last, self.v
        get, fits = v.ranks.get, v.fits
        for end in range(len(last), len(window) + 1):
            for length in range(end, 0, -1) if end < 24 else v.ending(window[end - 2 : end]):
                start = end - length
                if start < 0 or get(window[start:end]) is None:
                    continue
                if start == 0 or fits(window[start - last[start] : start], window[start:end]):
                    last.append(length)
                    break
            else:
                last.append(1)
        self.window = window

    def _emit(self, upto: int) -> list[int]:
        """Tokens of the encoding so far that end at or before `upto`; forgets them."""
        ends = []
        end = len(self.last) - 1
        while end > 0:
            ends.append(end)
            end -= self.last[end]
        out, start = [], 0
        for end in reversed(ends):
            if end > upto:
                break
            out.append(self.v.ranks[self.window[start:end]])
            start = end
        if start:
            self.window, self.base = self.window[start:], self.base + start
            self.last = [0] + self.last[start + 1 :]
            # positions whose last token reached back over the cut belong to encodings that can't come up any more
            for i in range(1, len(self.last)):
                if self.last[i] > i:
                    self.last[i] = i
        return out

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        ahead = self.v.sufficient_lookahead() + self.keep
        for i in range(0, len(data), 4096):
            self._extend(data[i : i + 4096])
            if len(self.window) > 2 * ahead:
                # the first token of the rest has `keep` bytes before it in the window, so no position in use is lost
                out += self._emit(len(self.window) - ahead)
        return out

    def close(self) -> list[int]:
        out = self._emit(len(self.window))
        self.reset()
        return out

    def encode(self, piece: bytes) -> list[int]:
        rank = self.v.ranks.get(piece)
        if rank is not None and (len(piece) == 1 or self.v.halves(piece)):
            return [rank]
        if len(piece) > 4096:
            return self.feed(piece) + self.close()
        start = piece[:BEGINNING]
        begun = self.begun.get(start)  # the state after these bytes doesn't depend on what follows
        if begun is None:
            self._extend(start)
            if len(self.begun) >= REMEMBERED:
                self.begun.clear()
            self.begun[start] = self.last[:]
        else:
            self.window, self.last = start, begun[:]
        self._extend(piece[BEGINNING:])
        return self.close()


class _Remembered(dict):
    """Piece -> its ids as packed 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.transducer = Transducer(vocabulary)

    def __missing__(self, piece: str) -> bytes:
        ids = self.transducer.encode(piece.encode())
        out = pack(f"<{len(ids)}i", *ids)
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = out
        return out


_pieces = regex.compile(PATTERN).findall


class StreamingEncoder:
    """Chunks of a text in, packed ids out. close() ends the text."""

    HOLD = 4  # characters that may still change where the piece before them ends

    def __init__(self, vocabulary: Vocabulary):
        self.known = _Remembered(vocabulary)
        self.rest = ""
        self.open: Transducer | None = None  # a piece longer than a chunk that has not ended
        self._long = Transducer(vocabulary)
        self._more = None

    #: kinds of pieces that can be long, each with the pattern of what continues it
    _KINDS = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\s+")]

    def feed(self, chunk: str) -> bytes:
        text = self.rest + chunk
        out: list[bytes] = []
        if self.open is not None:
            text = self._continue(text, out, final=False)
        if self.open is None:
            pieces, cut = _pieces(text), len(text)
            while pieces and cut > len(text) - self.HOLD:  # these may still end elsewhere
                cut -= len(pieces.pop())
            out += map(self.known.__getitem__, pieces)
            text = text[cut:]
            if len(text) >= CHUNK:
                self._begin(text)
                text = self._continue(text, out, final=False)
        self.rest = text
        return b"".join(out)

    def _begin(self, text: str) -> None:
        lead = 1 if text[0] == " " and len(text) > 1 and not text[1].isspace() else 0
        self._more = next(k for k in self._KINDS if k.match(text, lead))
        self.open, self._lead = self._long, lead

    def _continue(self, text: str, out: list[bytes], final: bool) -> str:
        """Feed the open piece with what surely belongs to it."""
        m = self._more.match(text, self._lead)
        end = m.end() if m else self._lead
        spaces = self._more is self._KINDS[3]
        if end == len(text) and not final:
            upto = max(0, end - self.HOLD)
            ids = self.open.feed(text[:upto].encode())
            self._lead = 0 if upto else self._lead
            rest = text[upto:]
        else:
            upto = end - 1 if spaces and end < len(text) else end  # the last space before other text stands apart
            ids = self.open.feed(text[:upto].encode()) + self.open.close()
            self.open = None
            rest = text[upto:]
        out.append(pack(f"<{len(ids)}i", *ids))
        return rest

    def close(self) -> bytes:
        out: list[bytes] = []
        text = self.rest
        if self.open is not None:
            text = self._continue(text, out, final=True)
        out += map(self.known.__getitem__, _pieces(text))
        self.rest = ""
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """The packed ids of a whole text."""
        if not text:
            return b""
        if len(text) <= CHUNK:
            return b"".join(map(self.known.__getitem__, _pieces(text)))
        return b"".join([self.feed(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)]) + self.close()

    def count(self, text: str | None) -> int:
        return len(self.encode(text)) >> 2


class StreamingDecoder:
    """Ids in, text out: bytes of an unfinished character wait for the rest; what never becomes one is U+FFFD."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes_of = {i: t for t, i in vocabulary.ranks.items()}
        self._state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self._state.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def close(self) -> str:
        out = self._state.decode(b"", True)
        self._state.reset()
        return out


_encoders: dict[str, StreamingEncoder] = {}


def encoder_of(data: bytes, name: str) -> StreamingEncoder:
    """This process's encoder for a vocabulary."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = StreamingEncoder(Vocabulary(data))
    return _encoders[name]


def ship_vocabulary(spark: SparkSession, path: str):
    """The vocabulary file's bytes as a broadcast, and a name for them."""
    with open(path, "rb") as f:
        data = f.read()
    return spark.sparkContext.broadcast(data), hashlib.sha1(data).hexdigest()


def vocabulary_path(spark: SparkSession, name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where the public vocabularies lie: the session's foliate.tokenizers, else /opt/tokenizers."""
    return f"{spark.conf.get('foliate.tokenizers', '/opt/tokenizers')}/{name}"


def encode_column(df: DataFrame, id_col: str, text_col: str, path: str, ids_col: str = "ids") -> DataFrame:
    """(id, ids) of every row. Nothing is shuffled; each text is encoded where it is read."""
    kind = df.schema[id_col].dataType.simpleString()
    shipped, name = ship_vocabulary(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(shipped.value, name).encode
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                parts = [encode(t) for t in batch.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, parts)], dtype=np.int64) >> 2
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(parts), "<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["a", "b"])

    return df.select(id_col, text_col).mapInArrow(run, f"a {kind}, b array<int>").toDF(id_col, ids_col)


def count_column(df: DataFrame, keep: list[str], text_col: str, path: str, out_col: str = "n_tokens") -> DataFrame:
    """The kept columns of every row with its number of tokens; the text itself goes no further."""
    types = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    shipped, name = ship_vocabulary(df.sparkSession, path)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder_of(shipped.value, name).count
        for batch in batches:
            counts = pa.array([count(t) for t in batch.column(n).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], counts], [*keep, out_col])

    return df.select(*keep, text_col).mapInArrow(run, f"{types}, {out_col} bigint")
