"""SentencePiece encoding and decoding by batched Viterbi in numpy (operator 2).

Pieces come from a SentencePiece model file. A text is cut at its spaces into words
that begin with the space mark; no piece reaches over such a cut. Of the ways to spell a
word in pieces the one of highest summed score is taken, as unigram models do. All
different words of a batch that have one length advance together: at every
place the hashes of the substrings that end there are looked up among the sorted hashes
of the pieces, and a vectorised maximum stores score and backpointer.

A model with log probabilities (unigram) gives its own scores. A model built from merges
stores only ranks; a piece of rank r then scores -log(r + 2) - ``PIECE_COST``, as its
frequency falls with its rank and every further piece costs a little. Merging in rank
order may spell a word otherwise, so these ids decode to the same text as that model's
but need not equal them.

Equal scores: the shorter last piece wins. Characters without a piece become the byte
pieces of their UTF-8 form. A word too long to have many of its length beside it is spelt
alone, all its substrings of one length looked up at once.

Cases: null and empty texts have no ids and decode to the empty text; an empty table gives
an empty table; repeated rows come back as often as they come; a very long text is coded
whole, also where it is a single word; any run of spaces, line ends and other white space survives the round
trip; the space mark U+2581 in a text comes back as a space, as the format has it.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
PIECE_COST = 2.0
CACHED_WORDS = 400_000
CELLS = 2_000_000
FILTER_BITS = 21
# Words of so many characters are spelt alone: few others have their length.
LONG_WORD = 100
# Texts of about so many bytes learn their words together.
BATCH_BYTES = 4 << 20
# Ids decoded together; what they become stays in the cache of a core.
BATCH_IDS = 1 << 17
_BASE = np.uint64(0x9E3779B97F4A7C15)


def code_points(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


class Pieces:
    """The pieces of a model file, sorted by hash, and the words spelt so far."""

    def __init__(self, path: str | None = None):
        import sentencepiece

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(model.get_piece_size())
        self.bytes = np.array([i for i in numbers if model.is_byte(i)], np.int32)
        self.unknown = model.unk_id()
        special = set(self.bytes.tolist()) | {i for i in numbers if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        plain = [i for i in numbers if i not in special]
        self.text = [model.id_to_piece(i) for i in numbers]
        self.byte_of = {int(i): bytes([at]) for at, i in enumerate(self.bytes)}
        self.silent = special - set(self.byte_of)
        raw = np.array([model.get_score(i) for i in plain])
        if (raw == np.round(raw)).all():
            ranks = np.where(raw > -1e8, -raw, len(numbers))
            scores = -np.log(ranks + 2) - PIECE_COST
        else:
            scores = raw
        lengths = np.array([len(self.text[i]) for i in plain])
        keys = np.array([self._key(self.text[i]) for i in plain], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(plain, np.int32)[order]
        self.scores, self.lengths = scores[order], lengths[order]
        self.longest = int(lengths.max())
        # Most substrings are no piece; a table of the keys' first bits tells so before the search.
        self.possible = np.zeros(1 << FILTER_BITS, bool)
        self.possible[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        # What each piece stands for: all forms in one buffer, with the mark as a blank.
        forms = [self.byte_of.get(i, b"" if i in self.silent else self.text[i].replace(MARK, " ").encode("utf-8", "surrogatepass")) for i in numbers]
        self.form_size = np.array([len(f) for f in forms], np.int64)
        self.form_at = np.cumsum(self.form_size) - self.form_size
        self.forms = np.frombuffer(b"".join(forms), np.uint8)
        self.missing = float(scores.min()) - 10.0
        # Word without its first mark -> its ids as little-endian 32-bit numbers.
        self.spelt: dict[str, bytes] = {}

    @staticmethod
    def _key(piece: str) -> int:
        key = 0
        for char in piece:
            key = (key * int(_BASE) + ord(char) + 1) % (1 << 64)
        return key

    def _lookup(self, keys: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """``(rows, places)``: which keys are those of a piece of that length, and its place among the sorted keys."""
        rows = np.flatnonzero(self.possible[(keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        some = keys[rows]
        at = np.searchsorted(self.keys, some)
        at[at == len(self.keys)] = 0
        right = (self.keys[at] == some) & (self.lengths[at] == length)
        return rows[right], at[right]

    def spell(self, words: list[str]) -> list[bytes]:
        """Ids of words of one length, advanced together."""
        n, size = len(words), len(words[0])
        codes = code_points(words).reshape(n, size) + np.uint64(1)
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0.0
        back = np.zeros((size + 1, n), np.int32)
        piece = np.full((size + 1, n), -1, np.int32)
        # The hash of the last k characters, for every k; moving on adds a character to each.
        tails = np.zeros((0, n), np.uint64)
        for end in range(1, size + 1):
            head = np.concatenate([np.zeros((1, n), np.uint64), tails])[: self.longest]
            tails = head * _BASE + codes[:, end - 1]
            # A character that is no piece stands for itself.
            best[end] = best[end - 1] + self.missing
            back[end] = end - 1
            for k in range(1, len(tails) + 1):
                rows, at = self._lookup(tails[k - 1], k)
                score = best[end - k][rows] + self.scores[at]
                # One character that is a piece is never worse than one that is none.
                wins = score > best[end][rows]
                rows, at = rows[wins], at[wins]
                best[end][rows] = score[wins]
                back[end][rows] = end - k
                piece[end][rows] = at
        ends, row = np.full(n, size), np.arange(n)
        steps, lone = [], np.zeros(n, bool)
        while (ends > 0).any():
            at = np.where(ends > 0, piece[ends, row], -2)
            steps.append(np.where(at >= 0, self.ids[at], -1))
            lone |= at == -1
            ends = np.where(ends > 0, back[ends, row], 0)
        ids = np.stack(steps[::-1], 1)
        counts = np.cumsum((ids >= 0).sum(1)) * 4
        flat = ids[ids >= 0].astype("<i4").tobytes()
        found = [flat[a:b] for a, b in zip([0, *counts[:-1].tolist()], counts.tolist(), strict=True)]
        for i in np.flatnonzero(lone).tolist():
            found[i] = self._with_bytes(words[i], piece[:, i], back[:, i])
        return found

    def _with_bytes(self, word: str, piece: np.ndarray, back: np.ndarray) -> bytes:
        """Ids of a word in which some character is no piece."""
        parts, end = [], len(word)
        while end:
            parts.append([int(self.ids[piece[end]])] if piece[end] >= 0 else self._bytes(word[end - 1]))
            end = int(back[end])
        return np.array([i for part in reversed(parts) for i in part], "<i4").tobytes()

    def _bytes(self, char: str) -> list[int]:
        if len(self.bytes) < 256:
            return [self.unknown]
        return [int(self.bytes[b]) for b in char.encode("utf-8", "replace")]

    def spell_long(self, word: str) -> bytes:
        """Ids of one long word: its places advance together in the lookup, and the best way is found along them.

        All substrings of one length are hashed and looked up at once; what is left for each
        character is the maximum over the few pieces that end there.
        """
        codes, size = code_points([word]) + np.uint64(1), len(word)
        ending: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
        tails = np.zeros(size, np.uint64)
        for k in range(1, min(self.longest, size) + 1):
            # Row i holds the hash of the k characters from i on.
            tails = tails[: size - k + 1] * _BASE + codes[k - 1 :]
            rows, at = self._lookup(tails, k)
            for row, place in zip(rows.tolist(), at.tolist()):
                ending[row + k].append((k, place))
        scores = self.scores.tolist()
        best, back, piece = [0.0] * (size + 1), np.zeros(size + 1, np.int32), np.full(size + 1, -1, np.int32)
        for end in range(1, size + 1):
            top, length, chosen = best[end - 1] + self.missing, 1, -1
            for k, place in ending[end]:
                score = best[end - k] + scores[place]
                if score > top:
                    top, length, chosen = score, k, place
            best[end], back[end], piece[end] = top, end - length, chosen
        return self._with_bytes(word, piece, back)

    def learn(self, words: set[str]) -> None:
        """Spell words (without their first mark), those of one length together."""
        by_size: dict[int, list[str]] = {}
        for word in words:
            if len(word) >= LONG_WORD:
                self.spelt[word] = self.spell_long(MARK + word)
            else:
                by_size.setdefault(len(word), []).append(word)
        for size, some in by_size.items():
            step = max(1, CELLS // (size + 2))
            for at in range(0, len(some), step):
                part = some[at : at + step]
                self.spelt.update(zip(part, self.spell([MARK + word for word in part]), strict=True))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        cut = [words_of(text) for text in texts]
        if len(self.spelt) > CACHED_WORDS:
            self.spelt.clear()
        unknown: set[str] = set()
        for words in cut:
            unknown.update(set(words).difference(self.spelt))
        self.learn(unknown)
        return [np.frombuffer(b"".join(map(self.spelt.__getitem__, words)), "<i4") for words in cut]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of the id lists that ``offsets`` cuts ``ids`` into."""
        size = self.form_size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(self.form_at[ids] - (ends - size), size)
        data = self.forms[shift + np.arange(total)].tobytes()
        cuts = np.concatenate([[0], ends])[offsets].tolist()
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]
        if MARK.encode() in data:
            texts = [text.replace(MARK, " ") for text in texts]
        return [text[1:] if text.startswith(" ") else text for text in texts]


def words_of(text: str | None) -> list[str]:
    """The words of the marked text, each without its first mark.

    The text gets a mark before it and for each space, and is cut before every mark that
    follows another character; a run of marks begins one word.
    """
    if not text:
        return []
    if MARK in text:
        text = text.replace(MARK, " ")
    words = text.split(" ")
    if "" not in words:
        return words
    found: list[str] = []
    marks = 0
    for word in words[:-1]:
        if word:
            found.append(MARK * marks + word)
            marks = 0
        else:
            marks += 1
    return [*found, MARK * marks + words[-1]]


_LOADED: dict[str | None, Pieces] = {}


def _pieces(path: str | None) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose rows have sizes of about ``most`` together."""
    part = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield batch.slice(a, b - a)


def _sizes(column: pa.Array) -> np.ndarray:
    length = pc.binary_length if pa.types.is_string(column.type) else pc.list_value_length
    return pc.fill_null(length(column), 0).to_numpy(zero_copy_only=False)


def encoded(docs: DataFrame, path: str | None = None, batch_bytes=BATCH_BYTES) -> DataFrame:
    """``(doc_id, ids)`` for every row of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        for batch in batches:
            for part in slices(batch, _sizes(batch.column(1)), batch_bytes):
                found = pieces.encode(part.column(1).to_pylist())
                yield pa.record_batch([part.column(0), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def decoded(tokens: DataFrame, path: str | None = None, batch_ids=BATCH_IDS) -> DataFrame:
    """``(doc_id, ids, text)``: the ids of ``tokens(doc_id, ids)`` and the text they stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        for batch in batches:
            for part in slices(batch, _sizes(batch.column(1)), batch_ids):
                offsets = np.concatenate([[0], np.cumsum(_sizes(part.column(1)))])
                texts = pieces.decode(part.column(1).flatten().to_numpy(zero_copy_only=False), offsets)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
