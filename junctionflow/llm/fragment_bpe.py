"""BPE encoding and decoding by forced boundaries.

Pairs of bytes that occur inside no token of the vocabulary are certain cuts (``boundaries``). Each text is cut there,
distinct fragments are encoded one by one with the tokenizers library, and the ids of a text are those of its fragments
in turn: the library's own ids. Special tokens' strings are tokens, as the library has it by default, and fragments of
their own. Decoding joins what the library decodes each fragment's ids to; fragments hold whole characters.

Null and empty texts have no ids. Rows are kept one to one, ties and repeats included; an empty table gives no rows;
columns other than doc_id and text are not read, so their names are free. A long text is worked through in parts of
``PART`` bytes that end at certain cuts. Bytes that are no UTF-8 count as replacement characters.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from junctionflow.llm import boundaries
from junctionflow.llm.common import documents, over_batches, utf8

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Bytes of fragments and of what is known of them that a Python worker remembers.
REMEMBERED = 128 << 20
#: Bytes of a text beyond which it is encoded in parts.
PART = 4 << 20


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printed characters of Latin-1 stand for
    themselves, the other bytes in turn for the characters from 256 on."""
    printed = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in printed]
    return {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(others)}


def token_bytes(path: str = TOKENIZER) -> list[bytes]:
    """The bytes of each token by id; special tokens as their strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special, value = {t["id"]: t["content"] for t in spec["added_tokens"]}, byte_values()
    out = [b""] * (1 + max([*spec["model"]["vocab"].values(), *special]))
    for token, i in spec["model"]["vocab"].items():
        out[i] = token.encode() if i in special else bytes(value[c] for c in token)
    for i, token in special.items():
        out[i] = token.encode()
    return out


class Encoder:
    """Ids and decoded bytes of texts by way of their fragments. ``special``: special strings are tokens."""

    def __init__(self, path: str = TOKENIZER, special: bool = True, most: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = not special
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content.encode() for t in added.values()] if special else []
        self.bytes = token_bytes(path)
        self.certain = boundaries.certain_pairs(boundaries.absent_pairs(t for i, t in enumerate(self.bytes) if i not in added))
        self.lengths, self.names = np.array([len(t) for t in self.bytes], np.int64), [f"{i},".encode() for i in range(len(self.bytes))]
        self.memory = boundaries.Memory(self._learn, most)

    def encode_plain(self, fragments: list[bytes]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast([f.decode() for f in fragments], add_special_tokens=False)]

    def _learn(self, fragments: list[bytes]) -> list[tuple]:
        """Of each fragment: its ids with a comma after each, their number, what they decode to, and the ids. Fragments
        that begin with a blank are encoded and decoded as one text, which costs less than one by one."""
        out: list[tuple] = [()] * len(fragments)
        for run in boundaries.runs(fragments, self.certain):
            some = [fragments[i] for i in run]
            ids = self.encode_plain([b"".join(some)])[0]
            decoded = self.tokenizer.decode(ids, skip_special_tokens=False).encode()
            at = [0, len(ids)] if len(some) == 1 else boundaries.divided(ids, self.lengths, some) if len(decoded) == sum(map(len, some)) else None
            if at is None:
                every = self.encode_plain(some)
                plain = [d.encode() for d in self.tokenizer.decode_batch(every, skip_special_tokens=False)]
            else:
                every, to = [ids[i:j] for i, j in zip(at, at[1:], strict=False)], np.cumsum([0, *map(len, some)]).tolist()
                plain = [decoded] if len(some) == 1 else [decoded[i:j] for i, j in zip(to, to[1:], strict=False)]
            for i, f, x, d in zip(run, some, every, plain, strict=True):
                out[i] = b"".join(map(self.names.__getitem__, x)), len(x), f if d == f else d, array("i", x).tobytes()
        return out

    def of(self, texts: list[bytes], *fields: int) -> tuple[np.ndarray, list]:
        """The number of ids of each text, and for each asked field (see ``_learn``) the texts' values, joined."""
        data, ends = boundaries.joined(texts)
        starts = boundaries.cuts(np.frombuffer(data, np.uint8), self.certain)
        boundaries.special_starts(data, ends, starts, self.special)
        distinct, turn, first = boundaries.fragments(data, ends, starts)
        known = self.memory.of(distinct)
        count = np.append(0, np.cumsum(np.array([k[1] for k in known], np.int64)[turn] if len(turn) else []))[first]
        out = []
        for field in fields:
            taken = pa.array([k[field] for k in known], pa.large_binary()).take(pa.array(turn))
            _, at, values = taken.buffers()
            at, values = np.frombuffer(at, np.int64)[: len(turn) + 1][first] if len(turn) else np.zeros(len(first), int), memoryview(values) if values else memoryview(b"")
            out.append([values[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])
        return np.diff(count).astype(np.int64), out


@lru_cache(maxsize=2)
def encoder(path: str, special: bool = True, most: int = REMEMBERED) -> Encoder:
    """One memory for all tasks of a Python worker."""
    return Encoder(path, special, most)


def valid(text: bytes) -> bytes:
    """A text whose bytes are UTF-8; others are replaced."""
    try:
        text.decode()
        return text
    except UnicodeDecodeError:
        return text.decode(errors="replace").encode()


def encode_documents(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, ids: the token ids of every whole text."""

    def per_batch(doc_id, text):
        ids = encoder(tokenizer).of([valid(t) for t in text], 3)[1][0]
        return {"doc_id": doc_id, "ids": [np.frombuffer(x, np.int32) for x in ids]}

    return over_batches(docs.select("doc_id", utf8().alias("text")), per_batch, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, text: what the library decodes the ids to, special tokens included."""

    def per_batch(doc_id, ids):
        return {"doc_id": doc_id, "text": encoder(tokenizer).tokenizer.decode_batch([x or [] for x in ids], skip_special_tokens=False)}

    return over_batches(encoded.select("doc_id", "ids"), per_batch, "doc_id long, text string")


def digests(docs: DataFrame, tokenizer: str = TOKENIZER, part: int = PART) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass, keeping only digests."""

    def of_parts(text: bytes) -> tuple[int, str, str]:
        enc, n, ids, decoded, comma = encoder(tokenizer), 0, hashlib.sha256(), hashlib.sha256(), b""
        for piece in boundaries.parts(text, enc.certain, part):
            count, (written, plain) = enc.of([piece], 0, 2)
            n += int(count[0])
            ids.update(comma)
            ids.update(written[0][:-1])
            decoded.update(plain[0])
            comma = b","
        return n, ids.hexdigest(), decoded.hexdigest()

    def per_batch(doc_id, text):
        text = [valid(t) for t in text]
        if sum(map(len, text)) > part:  # a long text stands alone, or ends its batch
            rows = [of_parts(t) for t in text]
            return {"doc_id": doc_id} | {c: [r[i] for r in rows] for i, c in enumerate(("n_tokens", "ids_sha256", "decoded_sha256"))}
        count, (written, plain) = encoder(tokenizer).of(text, 0, 2)
        return {"doc_id": doc_id, "n_tokens": count, "ids_sha256": [hashlib.sha256(x[:-1]).hexdigest() for x in written], "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in plain]}

    return over_batches(docs.select("doc_id", utf8().alias("text")), per_batch, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op12_fragment_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
