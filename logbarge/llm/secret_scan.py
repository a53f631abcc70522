"""Secret scan of whole texts: keyword automaton, anchored patterns near its hits, checksums.

An Aho-Corasick automaton finds every keyword in one pass over the text; a pattern runs only
anchored at (or just behind) a hit. Runs of hexadecimal digits have no keyword: any run of 24 or
more covers a multiple-of-24 position, so only those positions are probed. Tokens that embed a
checksum count only if it holds.

Kinds and their order: see ``KINDS``. The first three are the base kinds and follow
leftmost, non-overlapping matching per kind; a match that fails its length rule is dropped but
still consumes its characters. The others are found independently; spans of different kinds may
overlap.

Defined results: a null text counts as empty and has no span; spans are code points, end
exclusive; repeated rows are scanned each on its own; other columns are never read by the scan. Texts of
any length are scanned whole, in time that grows with their length: no pattern rescans what another
start of its kind has failed on. Parts nested too deep to read are no token.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import pick, slices

# Kinds in the order that breaks ties of the start position.
KINDS = ("assign", "access", "hex", "ghtoken", "npm", "jwt", "pem")
BASE_KINDS = KINDS[:3]

# The patterns, anchored where a keyword was hit.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_RUN = re.compile(r"[0-9a-f]+")
GH_TOKEN = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM_TOKEN = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
JWT_RUN = re.compile(r"[A-Za-z0-9_-]*")
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----[A-Za-z0-9+/=\s]+-----END \1-----")

# Keyword (lower case) -> kind.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign",
    "api_key": "assign", "apikey": "assign", "akia": "access",
    "ghp_": "ghtoken", "gho_": "ghtoken", "ghu_": "ghtoken", "ghs_": "ghtoken", "ghr_": "ghtoken",
    "npm_": "npm", "eyj": "jwt", "-----begin ": "pem",
}

MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

RESULT = T.StructType([
    T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType()),
])


def base62_checksum(body: str) -> str:
    """CRC32 of the text in six base-62 digits, as tokens of this style append it."""
    value, digits = binascii.crc32(body.encode()), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = BASE62[rest] + digits
    return digits


def _holds_checksum(match: re.Match) -> bool:
    return base62_checksum(match[1]) == match[2]


def _decodes(match: re.Match) -> bool:
    """Both leading parts of a signed token must be base64url of a JSON object, the first with ``alg``."""
    try:
        head, body = (
            json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))) for part in (match[1], match[2])
        )
    except (ValueError, RecursionError):  # nested beyond the reader's depth is no token either
        return False
    return isinstance(head, dict) and isinstance(body, dict) and "alg" in head


# kind -> pattern, test of the match
RULES = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= MIN_ASSIGN),
    "access": (ACCESS, lambda m: len(m[0]) >= MIN_ACCESS),
    "ghtoken": (GH_TOKEN, _holds_checksum),
    "npm": (NPM_TOKEN, _holds_checksum),
    "jwt": (JWT, _decodes),
    "pem": (PEM, lambda m: True),
}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def ascii_lower(text: str) -> str:
    """Lower-case A to Z only, so that positions stay those of the text."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def hex_runs(text: str) -> Iterator[tuple[int, int]]:
    """Maximal runs of 24 or more hexadecimal digits, by probing every 24th character."""
    done = 0
    for probe in _HEX_PROBE.finditer(text[MIN_HEX - 1 :: MIN_HEX]):
        at = probe.start() * MIN_HEX + MIN_HEX - 1
        if at < done:
            continue
        begin = at
        while begin > done and text[begin - 1] in _HEX_DIGITS:
            begin -= 1
        if begin > at - MIN_HEX + 1 and at + 1 < len(text) and text[at + 1] not in _HEX_DIGITS and at - begin + 1 < MIN_HEX:
            continue
        end = HEX_RUN.match(text, at).end()
        done = end
        if end - begin >= MIN_HEX:
            yield begin, end


_HEX_PROBE = re.compile(r"[0-9a-f]")
_HEX_DIGITS = frozenset("0123456789abcdef")


def find_secrets(text: str | None, words: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start and then kind order."""
    if not text:
        return []
    spans = [(begin, end, "hex") for begin, end in hex_runs(text)]
    free_from = dict.fromkeys(RULES, 0)
    hits = sorted((last + 1 - length, kind) for last, (length, kind) in words.iter(ascii_lower(text)))
    for begin, kind in hits:
        if begin < free_from[kind]:
            continue
        pattern, test = RULES[kind]
        match = pattern.match(text, begin)
        if match is None:
            if kind == "jwt":
                # its first part must reach the end of its run, so no later start in that run does better
                free_from[kind] = JWT_RUN.match(text, begin).end()
            continue
        free_from[kind] = match.end()
        if test(match):
            spans.append((begin, match.end(), kind))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def written_spans(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for begin, end, kind in spans)


def redacted(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    if not spans:
        return text
    parts, done = [], 0
    for begin, end, kind in spans:
        if begin >= done:
            parts += [text[done:begin], f"[{kind}]"]
        done = max(done, end)
    return "".join(parts) + text[done:]


def scan_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans as text."""
    rows = pick(docs, doc_id=id_column, text=text_column)
    schema = T.StructType([rows.schema["doc_id"], *RESULT.fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in slices(batches):
            out = []
            for text in batch["text"].to_pylist():
                spans = find_secrets(text, words)
                base = [s for s in spans if s[2] in BASE_KINDS]
                kinds = [s[2] for s in base]
                digest = hashlib.sha256(written_spans(base).encode()).hexdigest()
                out.append((*(kinds.count(k) for k in BASE_KINDS), digest, written_spans(spans)))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], schema.names
            )

    return rows.mapInArrow(scan, schema)


def redact_secrets(docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars") -> DataFrame:
    """All rows and columns of ``docs`` with the secrets in the text replaced by their kind in brackets.

    ``length_column`` takes the new length in code points where a text changed.
    """
    names = docs.columns
    plain = docs.toDF(*(f"c{k}" for k in range(len(names))))  # names with dots would not resolve
    has_length = length_column in names

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        at = names.index(text_column)
        for batch in slices(batches):
            columns = batch.columns
            before = columns[at].to_pylist()
            after = [redacted(t, find_secrets(t, words)) for t in before]
            columns[at] = pa.array(after, columns[at].type)
            if has_length:
                k = names.index(length_column)
                lengths = columns[k].to_pylist()
                lengths = [n if a == b else len(a) for n, a, b in zip(lengths, after, before, strict=True)]
                columns[k] = pa.array(lengths, columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return plain.mapInArrow(redact, plain.schema).toDF(*names)
