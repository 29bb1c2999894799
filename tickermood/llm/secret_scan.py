"""Secrets in texts (operator 9).

An Aho-Corasick automaton walks the A-Z lower-cased text once and finds the
keywords that start every kind of secret but hexadecimal runs. At a keyword, and only
there, the kind's regular expression is tried, anchored to it. Kinds whose format has
an embedded checksum are kept only if the checksum holds.

Base kinds: ``assign``, ``access``, ``hex``. Further kinds: ``github`` (classic token,
whose last six characters are the CRC32 of the rest in base 62), ``slack``,
``private_key`` (a PEM block) and ``card`` (16 digits that start with 4 or 5 and pass
the Luhn test; they are looked for where a hexadecimal run starts).
Spans are code points, the end is exclusive. Per kind they are the leftmost
ones that do not overlap; a match that fails its length or checksum is dropped but
still covers its text.

Cases: a null text is empty; a very long text is scanned whole. Spans that start at one place are
in the order of the kinds as listed. Repeated rows have their spans as often as they come. An
empty table gives an empty table.
"""

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
SLACK = re.compile(r"xox[abprs]-[0-9A-Za-z-]{20,}")
PRIVATE_KEY = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END (?:[A-Z]+ )*PRIVATE KEY-----")
CARD = re.compile(r"(?<![0-9A-Za-z])[45][0-9]{15}(?![0-9A-Za-z])")

BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "github", "slack", "private_key", "card"]
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _long_value(match: re.Match) -> bool:
    return len(match[2]) >= 12


def _long_key(match: re.Match) -> bool:
    return len(match[0]) >= 18


def github_checksum(match: re.Match) -> bool:
    value, left = "", zlib.crc32(match[0][4:-6].encode())
    while left:
        left, digit = divmod(left, 62)
        value = BASE62[digit] + value
    return value.rjust(6, "0") == match[0][-6:]


def luhn(match: re.Match) -> bool:
    digits = [int(c) for c in reversed(match[0])]
    return sum(sum(divmod(2 * d, 10)) if at % 2 else d for at, d in enumerate(digits)) % 10 == 0


def _always(match: re.Match) -> bool:
    return True


# Keyword in lower case -> (kind, pattern, test of the match).
ANCHORED = {
    **dict.fromkeys(["password", "passwd", "secret", "token", "apikey", "api_key"], ("assign", ASSIGN, _long_value)),
    "akia": ("access", ACCESS, _long_key),
    **dict.fromkeys(["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], ("github", GITHUB, github_checksum)),
    **dict.fromkeys(["xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"], ("slack", SLACK, _always)),
    "-----begin ": ("private_key", PRIVATE_KEY, _always),
}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, rule in ANCHORED.items():
        found.add_word(word, (len(word), *rule))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """A-Z lower-cased and nothing else, so that places stay the same."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def scan(text: str | None, words: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Spans ``(kind, start, end)`` ordered by start, then by kind as listed in ``KINDS``."""
    text = text or ""
    spans: list[tuple[str, int, int]] = []
    covered = dict.fromkeys(KINDS, 0)
    # Hits come by their last character; a kind's places must be tried from the left.
    hits = sorted((end - rule[0] + 1, *rule[1:]) for end, rule in words.iter(lowered(text))) if text else []
    for start, kind, pattern, holds in hits:
        if start < covered[kind]:
            continue
        match = pattern.match(text, start)
        if match:
            covered[kind] = match.end()
            if holds(match):
                spans.append((kind, start, match.end()))
    for run in HEX.finditer(text):
        spans.append(("hex", *run.span()))
        card = CARD.match(text, run.start())  # 16 digits are a hexadecimal run as well
        if card and luhn(card):
            spans.append(("card", *card.span()))
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0])))


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def masked(text: str | None, spans, mask="[SECRET]") -> str | None:
    """The text with every span replaced; spans that touch or overlap become one mask."""
    if text is None or not spans:
        return text
    parts, at = [], 0
    for _, start, end in spans:
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` for every row."""
    fields = {"doc_id": pa.int64(), "n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(),
              "base_sha256": pa.string(), "spans": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                spans = scan(text.as_py(), words)
                base = [span for span in spans if span[0] in BASE_KINDS]
                counts = [sum(span[0] == kind for span in base) for kind in BASE_KINDS]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((doc_id.as_py(), *counts, digest, joined(spans)))
            found = list(zip(*rows, strict=True)) or [[] for _ in fields]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(found, fields.values(), strict=True)], names=[*fields])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def mask_secrets(docs: DataFrame, text="text") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mask; all columns and rows stay."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in batches:
            values = [value.as_py() for value in batch.column(at)]
            hidden = pa.array([masked(value, scan(value, words)) for value in values], batch.column(at).type)
            yield batch.set_column(at, batch.schema.names[at], hidden)

    return docs.mapInArrow(run, docs.schema)
