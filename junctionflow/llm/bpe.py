"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Each document is encoded on its own, match by match of the splitting pattern, without special tokens. Long texts are
cut where the pattern must cut anyway, so that a piece never costs more than its own length:

* before a blank that stands between two ASCII letters, digits or full stops: no match goes on into it;
* inside a very long run of white space, whose matches follow from the pattern directly (all of the run but its last
  character is one match when text follows), because the library's regex engine runs out of stack there.

Nulls and empty texts have no ids. Rows are kept one to one, ties and repeats included; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from junctionflow.llm.common import documents, over_batches, utf8

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Characters up to which a text is encoded in one call.
PIECE = 1 << 16
#: White space as the library's regex engine has it (fixed values).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_SPACE = re.compile(f"[{SPACE}]{{4096,}}")
_SAFE = re.compile(r"(?<=[A-Za-z0-9.]) (?=[A-Za-z0-9.])")


@lru_cache(maxsize=4)
def encoding(ranks: str = RANKS):
    import tiktoken

    with open(ranks, "rb") as f:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[tuple[str, bool]]:
    """(piece, whether it is one match): the pieces make up the text and no match of the pattern crosses their ends."""
    at = 0
    for run in _LONG_SPACE.finditer(text) if len(text) > 4096 else ():
        yield from ((p, False) for p in _cut(text[at : run.start()], size))
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : at], True
    yield from ((p, False) for p in _cut(text[at:], size))


def _cut(text: str, size: int) -> Iterator[str]:
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    if at < len(text):
        yield text[at:]


def encode(text: str, ranks: str = RANKS) -> list[int]:
    enc = encoding(ranks)
    if len(text) <= 4096:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for piece, single in pieces(text):
        ids += enc._encode_single_piece(piece) if single else enc.encode_ordinary(piece)
    return ids


def encode_documents(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id, ids: the token ids of every whole text."""

    def per_batch(doc_id, text):
        return {"doc_id": doc_id, "ids": [encode(t.decode(errors="replace"), ranks) for t in text]}

    return over_batches(docs.select("doc_id", utf8().alias("text")), per_batch, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id, bytes: the raw bytes that the ids stand for; ids cut inside a character are bytes all the same."""

    def per_batch(doc_id, ids):
        return {"doc_id": doc_id, "bytes": [encoding(ranks).decode_bytes(x or []) for x in ids]}

    return over_batches(encoded.select("doc_id", "ids"), per_batch, "doc_id long, bytes binary")


def digests(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass, keeping only digests."""
    names: list[str] = []

    def per_batch(doc_id, text):
        enc = encoding(ranks)
        if not names:
            names.extend(map(str, range(enc.n_vocab)))
        out = {"doc_id": doc_id, "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for t in text:
            ids = encode(t.decode(errors="replace"), ranks)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
        return out

    return over_batches(docs.select("doc_id", utf8().alias("text")), per_batch, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
