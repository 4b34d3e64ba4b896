"""Token counts of the sections of documents, from one encoding of each whole document.

Encoding sections one by one gives other tokens than the model sees. Here a text is encoded once; the
byte spans of its tokens follow from the tokens' own lengths; and the spans are joined with the sections'
intervals by search in the sorted section starts. A token that crosses a boundary is allocated by a rule: ``first``
gives it to the section of its first byte, ``most`` to the one that holds most of its bytes (the earlier of
equals). So the sections' counts always add up to the document's.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bytegrams as bg
from tidemark.llm.frames import prepare
from tidemark.llm.paragraphs import lines_of

#: A vocabulary as lines of a token in base 64 and its rank; at most MOST_TOKENS, which bounds what is sent to tasks.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MOST_TOKENS = 500_000
# Fixed value: how that vocabulary divides texts before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
RULES = ("first", "most")
_SECTION = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("n_tokens", pa.int32()), ("n_crossing", pa.int32())])


@lru_cache(maxsize=2)
def _encoder(vocabulary: bytes, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in vocabulary.splitlines() if line)}
    sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


def section_of(starts: np.ndarray, token: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether it crosses a boundary.

    ``starts`` are the sections' first bytes in order, ``token`` the tokens' bounds: both cover the same bytes.
    """
    first = np.searchsorted(starts, token[:-1], side="right") - 1
    last = np.searchsorted(starts, token[1:] - 1, side="right") - 1
    crossing = last > first
    if rule == "most":
        for t in np.flatnonzero(crossing):
            edges = np.concatenate([[token[t]], starts[first[t] + 1 : last[t] + 1], [token[t + 1]]])
            first[t] += int(np.argmax(np.diff(edges)))
    return first, crossing


def count(docs: DataFrame, rule: str = "first", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_crossing and its sections.

    Sections are lines with their line ends: start and stop in characters, n_tokens, and n_crossing of those
    that cross a boundary. An empty section (after a final line end) has no tokens. A null or empty text has no section
    and no token. Repeated rows are counted alike; other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"the rule is one of {RULES}")
    with open(vocabulary, "rb") as file:
        data = file.read()
    if data.count(b"\n") > MOST_TOKENS:
        raise ValueError(f"the vocabulary has more than {MOST_TOKENS} tokens")
    sent = prepare(docs.sparkSession).sparkContext.broadcast(data)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sizes = _encoder(sent.value, pattern)
        for batch in batches:
            for piece in bg.slices(batch.column(1)):
                lines, of = lines_of(piece)
                full = np.diff(piece.bounds) > 0
                chars = np.concatenate([[0], np.cumsum((piece.data & 0xC0) != 0x80)])
                line_at = np.searchsorted(of, np.arange(len(full) + 1))
                tokens, crosses, per_line, per_line_crossing = [], [], np.zeros(len(of), dtype=np.int64), np.zeros(len(of), dtype=np.int64)
                for i in range(len(full)):
                    a, b = line_at[i], line_at[i + 1]
                    ids = np.array(encoder.encode_ordinary(piece.text(i).decode()), dtype=np.int64)
                    bounds = np.concatenate([[0], np.cumsum(sizes[ids])])
                    section, crossing = section_of(lines.bounds[a:b] - piece.bounds[i], bounds, rule)
                    per_line[a:b] = np.bincount(section, minlength=b - a)
                    per_line_crossing[a:b] = np.bincount(section[crossing], minlength=b - a)
                    tokens.append(len(ids))
                    crosses.append(int(crossing.sum()))
                use = full[of]
                offset = chars[piece.bounds[:-1]][of]
                parts = [chars[lines.bounds[:-1]] - offset, chars[lines.bounds[1:]] - offset, per_line, per_line_crossing]
                sections = pa.StructArray.from_arrays([pa.array(p[use], type=pa.int32()) for p in parts], fields=list(_SECTION))
                bounds = np.concatenate([[0], np.cumsum(np.where(full, np.diff(line_at), 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, piece.last - piece.first),
                        pa.array(tokens, type=pa.int64()),
                        pa.array(crosses, type=pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds), sections),
                    ],
                    names=["doc_id", "n_tokens", "n_crossing", "sections"],
                )

    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        scan, f"doc_id {kind}, n_tokens bigint, n_crossing bigint, sections array<struct<start:int,stop:int,n_tokens:int,n_crossing:int>>")
