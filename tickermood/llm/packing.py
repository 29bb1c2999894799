"""Pack token sequences by Karmarkar-Karp multiway differencing (operator 7).

A task tokenises its documents as they stream by. Whole windows are cut off the
front of a long document at once. What remains is cut into parts and gathered until
it fills ``windows`` windows nearly to capacity; these parts are then divided among the
windows by differencing: every part starts as a partition of its own, and the two
partitions of largest spread are merged, the fullest windows of one with the emptiest
of the other, until one is left. If its fullest window is above capacity, the number
of windows rises and the division is made again. The group is closed at a fixed total
(the last part is cut there), so a window lacks only a few tokens. The last group
of a task is cut to what whole windows hold; the rest fills sequences whose lengths are
powers of two, which need no padding.

Nothing is shuffled, and a task holds one group. Sequence ids carry the partition
number, so a repeated task gives the same ids.

Cases: a null or empty text has only the end id and is a document of one token. Rows
with a null or repeated id are packed like any other. An empty table has no pieces.
A special token written out in a text has its own id, as the library has it. A very long
text is cut into windows as a whole; repeated rows are packed as often as they come.
"""

import heapq
import itertools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

CAPACITY = 1024
WINDOWS = 16
PART_TOKENS = 128
SLACK = 10
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
CACHED_WORDS = 600_000

# Characters for which the pattern below cuts exactly as the tokenizer's own does.
PLAIN = re.compile("[\n -~À-ÖØ-öø-ɏ]*")
CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[^\s0-9A-Za-zÀ-ÖØ-öø-ɏ]+|\s+(?!\S)|\s+")


class Spaced(dict):
    """Ids of words with a space before them, cut and merged when first asked for."""

    def __init__(self, ids_of):
        self.ids_of = ids_of

    def __missing__(self, word: str) -> bytes:
        found = self.ids_of(" " + word)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found
        return found


class TokenBytes:
    """Token ids of texts as little-endian unsigned 32-bit numbers, by the ``tokenizers`` library.

    A plain text is cut into the pieces that the tokenizer merges on their own, so
    the ids of words can be kept; any other text goes to the tokenizer as a whole, and so
    does one that holds a special token.
    """

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.pieces: dict[str, bytes] = {}
        self.spaced = Spaced(self._ids)
        self.letters = {byte: char for char, byte in zip(*self._alphabet(), strict=True)}

    @staticmethod
    def _alphabet() -> tuple[str, list[int]]:
        """The printable character that byte-level vocabularies use for each byte."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        return "".join(map(chr, [*shown, *range(256, 256 + len(hidden))])), [*shown, *hidden]

    def _merged(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()

    def _ids(self, word: str) -> bytes:
        pieces = CUT.findall(word)
        if len(pieces) == 1:
            return self._merged(word)
        # The pieces of a word that holds several are met again more often than the word.
        if len(self.pieces) >= CACHED_WORDS:
            self.pieces.clear()
        known = self.pieces
        for piece in pieces:
            if piece not in known:
                known[piece] = self.spaced[piece[1:]] if piece[0] == " " and len(piece) > 1 else self._merged(piece)
        return b"".join(map(known.__getitem__, pieces))

    def forget(self) -> None:
        self.spaced.clear()
        self.pieces.clear()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not PLAIN.fullmatch(text) or any(token in text for token in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        # A single space between two other characters always starts a piece.
        first, *rest = re.split(r"(?<=\S) (?=\S)", text) if "  " in text or " \n" in text or "\n " in text or text[-1] == " " else text.split(" ")
        return self._ids(first) + b"".join(map(self.spaced.__getitem__, rest))


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: indices of ``sizes`` divided among ``windows`` sets of near-equal sums."""
    heap = []
    for at, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = size
        heap.append((-size, at, sums, [[at], *([] for _ in range(windows - 1))]))
    heapq.heapify(heap)
    serial = itertools.count(len(sizes))
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        sets = [in_a[i] + in_b[windows - 1 - i] for i in order.tolist()]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), next(serial), sums, sets))
    return heap[0][3] if heap else [[] for _ in range(windows)]


def divide(sizes: list[int], capacity: int, slack=SLACK) -> list[list[int]]:
    """Windows of at most ``capacity``; their number rises until differencing fits."""
    windows = max(1, -(-sum(sizes) // max(1, capacity - slack)))
    while True:
        sets = difference(sizes, windows)
        if all(sum(sizes[i] for i in s) <= capacity for s in sets):
            return [s for s in sets if s]
        windows += 1


class Packer:
    """Pieces ``(document, start, length)`` of one task, packed group by group."""

    def __init__(self, capacity=CAPACITY, windows=WINDOWS, part=PART_TOKENS, slack=SLACK):
        self.capacity, self.part, self.slack = capacity, min(part, capacity), min(slack, capacity - 1)
        self.group = windows * (capacity - self.slack)
        self.parts: list[tuple[object, int, int]] = []
        self.total = 0

    def add(self, document, tokens: int) -> Iterator[list[tuple]]:
        """Sequences, as lists of pieces, that this document completes."""
        start = 0
        while tokens - start >= self.capacity:
            yield [(document, start, self.capacity)]
            start += self.capacity
        while start < tokens:
            size = min(self.part, tokens - start, self.group - self.total)
            self.parts.append((document, start, size))
            self.total += size
            start += size
            if self.total == self.group:
                yield from self._close()

    def _close(self) -> Iterator[list[tuple]]:
        parts, self.parts, self.total = self.parts, [], 0
        if not parts:
            return
        for chosen in divide([size for _, _, size in parts], self.capacity, self.slack):
            sequence: list[tuple] = []
            for at in sorted(chosen):
                document, start, size = parts[at]
                if sequence and sequence[-1][0] is document and sequence[-1][1] + sequence[-1][2] == start:
                    sequence[-1] = (document, sequence[-1][1], sequence[-1][2] + size)
                else:
                    sequence.append(parts[at])
            yield sequence

    def finish(self) -> Iterator[list[tuple]]:
        """The last group: what whole windows do not hold goes to lengths that are powers of two."""
        rest = self.total % (self.capacity - self.slack)
        while rest:
            length = 1 << (rest.bit_length() - 1)
            rest -= length
            sequence = []
            while length:
                document, start, size = self.parts.pop()
                taken = min(size, length)
                if taken < size:
                    self.parts.append((document, start, size - taken))
                sequence.append((document, start + size - taken, taken))
                length -= taken
                self.total -= taken
            yield sequence
        yield from self._close()


def pack_documents(
    docs: DataFrame, capacity=CAPACITY, windows=WINDOWS, end_id=END_ID, path: str | None = None, with_ids=False
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, with ``ids`` on wish.

    A document's ids end with ``end_id``. ``path`` names the vocabulary file; unset, the
    installed public one is used.
    """
    fields = {
        "doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
        "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64(),
    }
    if with_ids:
        fields["ids"] = pa.list_(pa.int64())
    columns = ", ".join(f"{name} {'array<long>' if name == 'ids' else 'long'}" for name in fields)
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        packer = Packer(capacity, windows)
        serial = itertools.count(TaskContext.get().partitionId() << 40)
        rows: list[tuple] = []

        def place(sequence) -> None:
            number, offset = next(serial), 0
            for (doc_id, ids), start, length in sequence:
                part = ids[4 * start : 4 * (start + length)]
                row = (doc_id, start, length, zlib.crc32(part), len(ids) // 4, number, offset)
                rows.append((*row, np.frombuffer(part, "<u4")) if with_ids else row)
                offset += length

        def flushed() -> pa.RecordBatch:
            found = list(zip(*rows, strict=True))
            rows.clear()
            return pa.record_batch([pa.array(c, t) for c, t in zip(found, fields.values(), strict=True)], names=[*fields])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                document = (doc_id.as_py(), tokens.encode(text.as_py()) + end)
                for sequence in packer.add(document, len(document[1]) // 4):
                    place(sequence)
                if len(rows) > 4096:
                    yield flushed()
        for sequence in packer.finish():
            place(sequence)
        # The worker may serve other stages next; the words of this task are not theirs.
        tokens.forget()
        if rows:
            yield flushed()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, columns)


_LOADED: dict[str | None, TokenBytes] = {}


def _tokens(path: str | None) -> TokenBytes:
    """The tokenizer of this worker, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = TokenBytes(path)
    return _LOADED[path]
