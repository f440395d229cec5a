"""Secret scan: three fixed patterns, and novelty against primed zstandard.

Beside the patterns, every long unbroken string that stands shortly before or after a
sensitive word, or holds one, is a candidate, whatever its characters. A zstandard compressor is primed with a dictionary of common
identifiers and the text around the candidate; what the candidate adds to the
compressed size, in bits per character, is its novelty. Words and identifiers that the
surroundings or the dictionary explain compress away; keys do not, and are reported.

Defined results: null and empty texts have no spans. Positions are code points, the end
exclusive. Of a candidate that spans of patterns cover in part the rest is measured and
reported; one that they cover whole is not reported again.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from headway.llm.wordbytes import slices

# Kinds and patterns of the base spans, with the shortest length.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")

# Sensitive words of the context, and the strings near them that are looked at.
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api.?key|access.?key|private.?key|credential"
    r"|bearer|authorization|auth|client.?id|signature|connection.?string)",
    re.IGNORECASE | re.ASCII,
)
LEAST = 12
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=~$!@%^*-]{{{LEAST},}}")

# What code and configuration commonly contain; primes the compressor.
IDENTIFIERS = (
    "username password passwd passphrase secret token access_token refresh_token api_key apikey "
    "client_id client_secret private_key public_key credential credentials authorization bearer "
    "authenticate authentication signature connection_string database_url hostname localhost "
    "example.com https://www. http:// config.settings.default environment os.environ getenv "
    "import return function public static final string value required optional undefined null "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 your_password_here "
    "changeme placeholder xxxxxxxxxxxxxxxx "
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    spans = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6
    ]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


_PRIMED = zstandard.ZstdCompressionDict(
    IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
)


def novelty(candidate: str, before: str, after: str) -> float:
    """Bits per character that the candidate adds to its compressed surroundings."""
    squeeze = zstandard.ZstdCompressor(
        level=9, dict_data=_PRIMED, write_content_size=False, write_checksum=False
    )
    around = f"{after} {before}".encode("utf-8", "replace")
    body = candidate.encode("utf-8", "replace")
    added = len(squeeze.compress(around + body)) - len(squeeze.compress(around))
    return 8.0 * added / len(body)


def candidates(text: str, words: list[tuple[int, int]], reach: int) -> Iterator[tuple[int, int]]:
    """Unbroken strings that come within `reach` characters of a word, or hold it."""
    at = 0
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        while at < len(words) and words[at][1] + reach < a:
            at += 1
        if at == len(words):
            break
        # Words do not overlap: none that follows begins before this one.
        if words[at][0] - reach <= b:
            yield a, b


def free_parts(
    a: int, b: int, taken: list[tuple[int, int, int]], ends: list[int]
) -> Iterator[tuple[int, int]]:
    """What base spans leave of a candidate; `ends` are the highest ends so far.

    Behind a span every rest counts, it may be the end of a key, and so does one before a
    key. What stands before an assignment is part of a name and counts if it is long.
    """
    start = a
    for i in range(bisect_right(ends, a), len(taken)):
        first, kind, last = taken[i]
        if first >= b:
            break
        if first > start and (start > a or kind != 0 or first - start >= LEAST):
            yield start, first
        start = max(start, last)
    if start < b:
        yield start, b


def novel_spans(
    text: str, taken: list[tuple[int, int, int]], reach: int, window: int, least_bits: float
) -> list[tuple[int, int, int]]:
    """Candidates near a sensitive word, on either side, that are novel.

    What base spans cover of a candidate is theirs, the rest is looked at. A string is
    measured whole; if it is not novel but holds sensitive words, also behind the first of
    them and between them, since the words themselves are no novelty.
    """
    words = [m.span() for m in CONTEXT.finditer(text)]
    starts = [w[0] for w in words]
    ends = list(accumulate((e for _, _, e in taken), max))

    def novel(a: int, b: int) -> bool:
        before, after = text[max(0, a - window) : a], text[b : b + window]
        return novelty(text[a:b], before, after) >= least_bits

    found = []
    for whole in candidates(text, words, reach):
        for a, b in free_parts(*whole, taken, ends):
            if novel(a, b):
                found.append((a, 3, b))
                continue
            inside = words[bisect_left(starts, a) : bisect_left(starts, b)]
            if not inside:
                continue
            gaps = zip([a, *(e for _, e in inside)], [*(s for s, _ in inside), b], strict=True)
            first, *others = [(s, e) for s, e in gaps]
            rest = (others[0][0], b)
            if rest[1] - rest[0] >= LEAST and novel(*rest):
                others = []
                found.append((rest[0], 3, b))
            found += [(s, 3, e) for s, e in (first, *others) if e - s >= LEAST and novel(s, e)]
    return sorted(found)


def scan_text(
    text: str, reach: int = 40, window: int = 400, least_bits: float = 6.0
) -> list[tuple[int, int, int]]:
    """All spans of a text as (start, kind, end), by start, then kind."""
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + novel_spans(text, base, reach, window, least_bits))


def find_secrets(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of each document, `secrets` as array of (kind, start, end), and
    `redacted`, the text with every span replaced by a mark (null for a null text).

    No shuffle; a text is looked at whole, one at a time, and some megabytes of texts are
    held. Rows that repeat a document are scanned alike; an empty text has no spans.
    """
    rows = documents.select(*keep, "text")
    kinds = dict(rows.dtypes)
    schema = (
        ", ".join(f"`{c}` {kinds[c]}" for c in keep)
        + ", secrets array<struct<kind:string,start:bigint,end:bigint>>, redacted string"
    )
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = batch.column(len(keep)).to_pylist()
                spans = [scan_text(t) for t in texts]
                found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in s] for s in spans]
                clean = [redact(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[: len(keep)],
                        pa.array(found, pa.list_(span)),
                        pa.array(clean, pa.string()),
                    ],
                    names=[*keep, "secrets", "redacted"],
                )

    return rows.mapInArrow(scan, schema)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by the mark."""
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])
