"""Secrets in texts: known shapes, and random strings shown by few characters per token."""

from __future__ import annotations

import base64
import functools
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bytework import LOWER, runs, text_bytes
from tidemark.llm.common import arrow_map, pieces
from tidemark.llm.spans import SPANS, span_rows

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")
VOCABULARY = "byte_bpe_50k.tiktoken"
# Below this many characters per token a string of mixed classes is taken as random.
CHARS_PER_TOKEN = 2.0
RANDOM_LENGTH = 20
MASK = "[secret]"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_UUID = re.compile(r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}")
_DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)

_ALPHABET = np.zeros(256, dtype=bool)
_ALPHABET[[*range(48, 58), *range(65, 91), *range(97, 123), *map(ord, "+/_=-")]] = True
_HEX_BYTES = np.zeros(256, dtype=bool)
_HEX_BYTES[[*range(48, 58), *range(97, 103)]] = True


@functools.lru_cache(maxsize=2)
def ranked_vocabulary(path: str):
    """A tiktoken encoding from a file of ranks."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three base kinds."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def known_form(word: str) -> bool:
    """Digests of usual lengths and universally unique identifiers, which are random but no secrets."""
    return bool(_UUID.fullmatch(word)) or len(word) in DIGEST_LENGTHS and bool(_DIGEST.fullmatch(word))


def looks_random(word: str, encode) -> bool:
    """Letters and digits mixed, no known form, and few characters per token."""
    word = word.strip("=-_+/")
    if len(word) < RANDOM_LENGTH or known_form(word):
        return False
    if not any(c.isdigit() for c in word) or not any(c.isalpha() for c in word):
        return False
    return len(word) < CHARS_PER_TOKEN * len(encode(word))


def batch_spans(column: pa.Array, encode) -> list[list[tuple]]:
    """Spans of each text of a column without nulls.

    Runs of key characters are found over the bytes of all texts at once; only texts with a long run, a long
    hexadecimal run or a keyword are looked at one by one.
    """
    data, offsets = text_bytes(column)
    starts, ends, row = runs(_ALPHABET[data], offsets)
    long = ends - starts >= RANDOM_LENGTH
    candidates: dict[int, list[tuple[int, int]]] = {}
    for a, b, r in zip(starts[long].tolist(), ends[long].tolist(), row[long].tolist()):
        candidates.setdefault(r, []).append((a - int(offsets[r]), b - int(offsets[r])))
    hex_starts, hex_ends, hex_row = runs(_HEX_BYTES[data], offsets)
    hit = set(hex_row[hex_ends - hex_starts >= 24].tolist()) | set(candidates)
    low = LOWER[data].tobytes()
    for word in _KEYWORDS:
        at = low.find(word)
        while at >= 0:
            r = int(np.searchsorted(offsets, at, side="right")) - 1
            hit.add(r)
            at = low.find(word, int(offsets[r + 1]))
    found: list[list[tuple]] = [[] for _ in range(len(column))]
    for r in hit:
        text = column[r].as_py()
        spans, raw = base_spans(text), text.encode()
        for a, b in candidates.get(r, []):
            if looks_random(raw[a:b].decode(), encode):
                begin = len(raw[:a].decode())
                end = begin + b - a
                if not any(s < end and e > begin for _, s, e in spans):
                    spans.append(("random", begin, end))
        found[r] = [(k, s, e, 1.0, text[s:e]) for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))]
    return found


def _path(vocabulary: str | None) -> str:
    name = vocabulary or VOCABULARY
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def find_secrets(docs: DataFrame, vocabulary: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All spans of every document, in code points with exclusive ends, ordered by start and kind.

    Runs of at least 20 characters of the usual key alphabets that are no digest or identifier and need many tokens become
    spans of kind ``random`` unless a base span covers them. Every row gives one row: null and empty texts have no
    spans, null ids stay null, repeated rows repeat; other columns are ignored. Nothing is shuffled.
    """
    path = _path(vocabulary)

    def run(batches):
        encode = ranked_vocabulary(path).encode_ordinary
        for batch in pieces(batches, text_column):
            yield span_rows(batch.column(0).to_pylist(), batch_spans(batch.column(1), encode))

    return arrow_map(docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")), run, SPANS)


def masked(text: str, spans: list[tuple], mask: str) -> str:
    """The text with all spans replaced; spans that overlap become one mark."""
    out, last = [], 0
    for _, start, end, *_ in spans:
        if start >= last:
            out += [text[last:start], mask]
        last = max(last, end)
    return "".join(out) + text[last:]


def mask_secrets(docs: DataFrame, mask: str = MASK, vocabulary: str | None = None, text_column: str = "text") -> DataFrame:
    """The documents with every secret replaced by a mark; all rows and columns stay, null texts too."""
    path = _path(vocabulary)
    scan, changed, names = "_scan_text", "_masked_text", docs.columns
    shape = T.StructType([*docs.schema.fields, T.StructField(changed, T.StringType())])

    def run(batches):
        encode = ranked_vocabulary(path).encode_ordinary
        for batch in pieces(batches, scan):
            column = batch.column(batch.num_columns - 1)
            new = [masked(column[r].as_py(), s, mask) if s else None for r, s in enumerate(batch_spans(column, encode))]
            yield {name: batch.column(k) for k, name in enumerate(names)} | {changed: new}

    rows = arrow_map(docs.withColumn(scan, F.col(text_column).cast("string")), run, shape)
    return rows.select(*[F.coalesce(changed, F.col(f"`{c}`")).alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns])
