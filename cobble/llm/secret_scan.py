"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

Base kinds (spans in code points, end exclusive, of the whole match):

* ``assign``: a keyword, a separator and a value of 6 or more characters;
* ``access``: ``AKIA`` keys of 20 or more characters;
* ``hex``: runs of 24 or more lower-case hex digits.

The method adds kind ``entropy``. A candidate is a run of 20 or more characters that can stand in a
key. Over each run of one character class (``CLASSES``) inside it slides a window; the counts of its
characters, and with them the sum of c*log2(c), are updated by the one character that leaves and the
one that enters, so a step costs the same whatever the window. Windows at or above the class's
entropy whose class demands (digits, cases) are met are merged to spans. A candidate that an
allow-list pattern matches in full (UUIDs, counting sequences, documented sample keys, paths) is
suppressed, and so is a span that a base span already covers; base spans always stay.

Null text: empty, no spans. Repeated rows: one result row each. Very long texts are scanned whole,
and memory is bounded by the text itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Sequence
from math import log2

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cobble.llm.common import prepare, slices, texts

#: Fixed values of the result's contract.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
#: Class, its characters, window, least entropy in bits, and patterns that a window must contain.
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F]{20,}"), 20, 2.9, (re.compile("[0-9]"), re.compile("[a-fA-F]"))),
    (
        "base64",
        re.compile(r"[A-Za-z0-9+/_=-]{20,}"),
        20,
        3.6,
        (re.compile("[0-9]"), re.compile("[a-z]"), re.compile("[A-Z]")),
    ),
    ("upper", re.compile(r"[A-Z0-9]{20,}"), 20, 3.6, (re.compile("[0-9].*[0-9]"), re.compile("[A-Z]"))),
    ("lower", re.compile(r"[a-z0-9]{20,}"), 20, 3.5, (re.compile("[0-9].*[0-9]"), re.compile("[a-z]"))),
)


def _begun(chars: str) -> str:
    """Pattern of the beginnings of ``chars``, the empty one included."""
    out = ""
    for c in reversed(chars):
        out = f"(?:{c}{out})?"
    return out


ALLOW = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"(0123456789)+[0-9]*",
    # Counting sequences of digits and letters, the last one maybe cut short, and an alphabet's signs.
    rf"(?i:(?:0?(?:123456789|abcdef{_begun('ghijklmnopqrstuvwxyz')}))+(?:{_begun('0123456789')}|{_begun('123456789')}|{_begun('abcdef')}))[+/_=-]*",
    # Sample keys of the form that documentation shows: an access key and its secret.
    r"([A-Za-z0-9_-]+=)?(AKIA[A-Z0-9]{9}EXAMPLE|[A-Za-z0-9+/]{30}EXAMPLEKEY)",
    r"[A-Za-z]+([/_-]+[A-Za-z]+)*[0-9]{0,4}",
    # Integrity digests: whole base64 of 20, 32, 48 or 64 bytes.
    r"sha1-[A-Za-z0-9+/]{27}=|sha256-[A-Za-z0-9+/]{43}=|sha384-[A-Za-z0-9+/]{64}|sha512-[A-Za-z0-9+/]{86}==",
)


def hot_windows(text: str, width: int, least: float) -> list[int]:
    """Starts of the windows of ``width`` whose Shannon entropy is at least ``least`` bits."""
    if len(text) < width:
        return []
    term = [0.0] + [c * log2(c) for c in range(1, width + 2)]
    most = (log2(width) - least) * width + 1e-9  # entropy = log2(width) - sum / width
    counts: dict[str, int] = {}
    total, hot = 0.0, []
    for i, ch in enumerate(text):
        c = counts.get(ch, 0)
        total += term[c + 1] - term[c]
        counts[ch] = c + 1
        if i >= width:
            old = text[i - width]
            c = counts[old]
            total += term[c - 1] - term[c]
            counts[old] = c - 1
        if i >= width - 1 and total <= most:
            hot.append(i - width + 1)
    return hot


def entropy_spans(text: str, allow: Sequence[re.Pattern]) -> list[tuple[int, int]]:
    """Merged spans of high-entropy windows in the candidates that no allow-list pattern matches."""
    found: list[tuple[int, int]] = []
    for cand in CANDIDATE.finditer(text):
        if any(a.fullmatch(cand[0]) for a in allow):
            continue
        own: list[tuple[int, int]] = []
        for _, chars, width, least, needs in CLASSES:
            for run in chars.finditer(cand[0]):
                if not all(n.search(run[0]) for n in needs):
                    continue
                base = cand.start() + run.start()
                for at in hot_windows(run[0], width, least):
                    if all(n.search(run[0], at, at + width) for n in needs):
                        own.append((base + at, base + at + width))
        for a, b in sorted(own):
            if found and a <= found[-1][1]:
                found[-1] = (found[-1][0], max(b, found[-1][1]))
            else:
                found.append((a, b))
    return found


def scan(text: str, allow: Sequence[re.Pattern]) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """(start, kind, end) of the base spans, and of all spans, by start and then kind as listed."""
    base = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    base += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    base += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    base.sort(key=lambda s: (s[0], KINDS.index(s[1])))
    more, at, reach = [], 0, 0
    for a, b in entropy_spans(text, allow):
        # Both lists ascend: the furthest end of the base spans that begin at or before ``a``.
        while at < len(base) and base[at][0] <= a:
            reach = max(reach, base[at][2])
            at += 1
        if reach < b:
            more.append((a, "entropy", b))
    return base, sorted(base + more, key=lambda s: (s[0], KINDS.index(s[1])))


def joined(spans: Iterable[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


def masked(text: str, spans: Iterable[tuple[int, str, int]], mask: str) -> str:
    """The text with every span, overlapping ones joined, replaced by ``mask``."""
    out, at = [], 0
    for a, _, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


RESULT = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_entropy bigint, "
    "base_sha256 string, spans string"
)
RESULT_ARROW = pa.schema(
    [("doc_id", pa.int64())]
    + [(f"n_{k}", pa.int64()) for k in KINDS]
    + [("base_sha256", pa.string()), ("spans", pa.string())]
)


def find_secrets(docs: DataFrame, allow: Sequence[str] = ALLOW) -> DataFrame:
    """Spans of secrets per row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)

    def find(batches):
        allowed = [re.compile(a, re.DOTALL) for a in allow]
        for batch in slices(batches):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                base, spans = scan(text, allowed)
                kinds = [k for _, k, _ in spans]
                sha = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append([doc, *(kinds.count(k) for k in KINDS), sha, joined(spans)])
            cols = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, RESULT_ARROW, strict=True)], schema=RESULT_ARROW
            )

    return texts(docs).mapInArrow(find, RESULT)


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", allow: Sequence[str] = ALLOW) -> DataFrame:
    """``docs`` with every span replaced in ``text_col``; other columns and null texts stay."""
    prepare(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(column: pd.Series) -> pd.Series:
        allowed = [re.compile(a, re.DOTALL) for a in allow]
        return column.map(lambda t: t if t is None else masked(t, scan(t, allowed)[1], mask))

    return docs.withColumn(text_col, clean(F.col(text_col)))
