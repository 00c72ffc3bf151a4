"""Secret scans: fixed patterns, and random strings that cost a tokenizer many tokens."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelvigil.llm.common import map_batches, map_columns, table, worker_state
from modelvigil.llm.tokens import default_path

#: Order of the kinds: base patterns, then the token-efficiency test.
KINDS = ("assign", "access", "hex", "random")

# The base patterns and their least lengths.
_ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

#: A text without one of these words has no assignment; most texts have none.
_ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")

#: A run of at least so many characters is tested; fewer characters a token than this is random.
RANDOM_LEAST, RANDOM_RATIO = 16, 2.2
#: Letters of words and identifiers have at least so many characters a token; fewer letters than this do not tell.
WORD_RATIO, WORD_LEAST = 1.9, 8
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}+")
#: Lengths of md5, sha1, sha224, sha256, sha384 and sha512 digests in hexadecimal digits.
DIGESTS = (32, 40, 56, 64, 96, 128)
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_HEX_ONLY = re.compile(r"[0-9a-fA-F]+")
_JOINT = re.compile(r"[-_/+=]+")
_LETTERS_THEN_DIGITS = re.compile(r"[A-Za-z]*[0-9]*|[0-9]+[A-Za-z]+")

def _loaded(path: str) -> tiktoken.Encoding:
    import public_tokenizers

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary(path: str) -> tiktoken.Encoding:
    """The vocabulary of a rank file."""
    return worker_state(path, _loaded)


def is_known(run: str, encoding: tiktoken.Encoding) -> bool:
    """A digest, a UUID, a number, or an identifier: words and numbers joined by marks, none of them mixed.

    Letters are words by their own cost, taken together over the run; capitals of joined words count as small letters.
    """
    if _HEX_ONLY.fullmatch(run) and len(run) in DIGESTS or _UUID.fullmatch(run) or run.isdigit():
        return True
    parts = _JOINT.split(run)
    if not all(_LETTERS_THEN_DIGITS.fullmatch(part) for part in parts):
        return False
    words = [word for part in parts if (word := part.strip("0123456789"))]
    if len(words) > 1:
        words = [word.lower() if word.isupper() else word for word in words]
    size = sum(map(len, words))
    return size < WORD_LEAST or size >= WORD_RATIO * sum(len(encoding.encode_ordinary(word)) for word in words)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end (exclusive) and kind, leftmost and not overlapping within a kind, in order of start, then kind."""
    found = []
    lower = text.lower()
    if any(word in lower for word in _ASSIGN_WORDS):
        found += [
            (m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST
        ]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2])))


def random_spans(text: str, encoding: tiktoken.Encoding, least: int = RANDOM_LEAST, ratio: float = RANDOM_RATIO) -> list:
    """Runs that take more than one token for ``ratio`` characters and are not known."""
    found = []
    for m in _RUN.finditer(text):
        run = m[0]
        if len(run) < least:
            continue
        if len(run) < ratio * len(encoding.encode_ordinary(run)) and not is_known(run, encoding):
            found.append((m.start(), m.end(), "random"))
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def secret_spans(docs: DataFrame, ranks: str, least: int = RANDOM_LEAST, ratio: float = RANDOM_RATIO) -> DataFrame:
    """Spans of secrets in every row: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``n_random``,
    ``base_sha256`` (of the joined base spans) and ``spans`` (all of them as kind:start:end in code points).

    Null text counts as empty and has no span. The test by token efficiency only adds spans; a base span stays
    whatever it is. Repeated rows and null ids are returned as they come. Other columns are not read.
    """
    out = pa.schema([
        ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
        ("n_random", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()),
    ])
    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        encoding = vocabulary(ranks)
        for batch in batches:
            rows: dict[str, list] = {name: [] for name in out.names}
            rows["doc_id"] = batch["doc_id"]
            for text in batch["text"]:
                base = base_spans(text or "")
                every = base + random_spans(text or "", encoding, least, ratio)
                every.sort(key=lambda span: (span[0], KINDS.index(span[2])))
                kinds = [span[2] for span in every]
                for kind in KINDS:
                    rows[f"n_{kind}"].append(kinds.count(kind))
                rows["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                rows["spans"].append(joined(every))
            yield rows

    return map_columns(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")], schema, work, out, stateful=True)


def masked(text: str, encoding: tiktoken.Encoding) -> str:
    """The text with each span, overlapping ones together, replaced by the kind of its first."""
    spans = sorted(base_spans(text) + random_spans(text, encoding), key=lambda s: (s[0], KINDS.index(s[2])))
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, ranks: str) -> DataFrame:
    """``docs`` with every secret in ``text`` masked, and ``n_chars`` made to fit where a text changed.

    Null texts stay null; rows and columns stay, none is added.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary(ranks)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            after = [t if t is None else masked(t, encoding) for t in texts]
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            columns["text"] = pa.array(after, type=batch.schema.field("text").type)
            if "n_chars" in columns:
                sizes = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array(
                    [size if old == new else len(new) for old, new, size in zip(texts, after, sizes)],
                    type=batch.schema.field("n_chars").type,
                )
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return map_batches(docs, work, stateful=True)


def op8_secrets(spark, folder: str) -> DataFrame:
    return secret_spans(table(spark, folder, "documents"), default_path("byte_bpe_50k.tiktoken"))
