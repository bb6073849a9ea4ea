"""Packing by concatenate and cut.

The token ids of all documents, each closed by an end id, form one long row, which is cut every ``length`` ids. Pass one
tokenizes whole texts and writes each document's ids with its offset inside its partition. The partition totals give
every partition its global offset by a prefix sum; pass two cuts each document at the fixed window borders. A document
that crosses borders leaves one piece per window, so every id lies in exactly one piece and only the last window is
short of full.

Scale: texts and ids never move between tasks. The only exchange holds one total per partition.

Edge cases: a null or empty text is a document of the end id alone. Null or repeated ids stay apart, since order is by
place in the written table. An empty table gives no piece. Other columns are ignored.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import materialise

LENGTH = 4096
END = 2
ROWS = 256
TOKENIZER = "word_bpe_49k.json"
MEMO_BYTES = 80 << 20  # of each of two generations
MEMO_CHARS = 64
MEMO_BATCH_CHARS = 1 << 20

# A cut before ASCII punctuation, a digit or white space after a run of Latin letters is a word border for every
# tokenizer that splits words by character class; anything else goes to the tokenizer up to the next white space. Capital
# dotted I is left out: in lower case it ends in a mark, which joins what follows.
_WORD = r"[A-Za-zÀ-ÖØ-öø-įı-ɏ]+"
_PARTS = re.compile(_WORD + r"(?=[\x21-\x40\x5B-\x60\x7B-\x7E \n\t\r]|$)|[^ \n\t\r]+")
# beyond Latin letters and their punctuation lower case may depend on what stands around a letter
_ODD = re.compile("[^\x00-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u203e\u20ac]")
_ONE_WORD = re.compile(_WORD).fullmatch
# bytes without a printable Latin-1 letter of their own stand for letters from 256 on, in their order
_PLAIN_BYTES = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LETTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PLAIN_BYTES)}


class WordTokenizer:
    """Token ids of texts, remembered by piece; for tokenizers that drop white space and never join words across it.

    A text is split at blanks, tabs and line ends, which a tokenizer drops wherever they stand, and pieces seen before are
    looked up whole. What is remembered is bounded in bytes: a full memory becomes the older one, from which pieces are
    taken over when they are met again. Longer pieces are tokenized each time.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        # the worker process keeps tokenizer and memory between tasks
        kept = tokenizers.__dict__.setdefault("_word_memo", {})
        if path not in kept:
            kept[path] = (tokenizers.Tokenizer.from_file(path), {"": b""}, {}, [0])
        self.tokenizer, self.memo, self.older, self.held = kept[path]
        # the shortcut for words is taken where it gives the tokenizer's ids
        self.model = self.tokenizer.model
        probe = "Ordinary wörds ÀÉÎÕÜ ŁódŹ Ǆ naïve strengths ə".split()
        self._learn_words(probe)
        short = [np.frombuffer(self.memo.pop(w), "<u4").tolist() for w in probe]
        if sys.byteorder != "little" or short != [self.tokenizer.encode(w, add_special_tokens=False).ids for w in probe]:
            self.model = None

    def _learn_words(self, words: list[str]) -> None:
        """Words of Latin letters are one unit of a byte-level model, which takes them in lower case, byte by byte."""
        own, found = self.model.tokenize, {}
        for word in words:
            spelt = word.lower()
            if not spelt.isascii():
                spelt = spelt.encode().decode("latin-1").translate(_BYTE_LETTERS)
            found[word] = array("I", [t.id for t in own(spelt)]).tobytes()
        self._remember(found)

    def learn(self, parts: set[str]) -> None:
        if self.model is not None:
            words = [p for p in parts if _ONE_WORD(p)]
            self._learn_words(words)
            parts = parts.difference(words)
        held, size = [], 0
        for part in parts:
            held.append(part)
            size += len(part) + 1
            if size > MEMO_BATCH_CHARS:
                self._learn(held)
                held, size = [], 0
        if held:
            self._learn(held)

    def _learn(self, parts: list[str]) -> None:
        got = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        begin = np.fromiter((a for a, _ in got.offsets), np.int64, len(got))
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        cuts = [0, *(4 * np.searchsorted(begin, ends)).tolist()]
        raw = np.asarray(got.ids, "<u4").tobytes()
        self._remember({p: raw[a:b] for p, a, b in zip(parts, cuts, cuts[1:])})

    def _remember(self, ids: dict[str, bytes]) -> None:
        self.memo.update(ids)
        self.held[0] += 200 * len(ids) + 2 * sum(map(len, ids)) + sum(map(len, ids.values()))

    def _take_over(self, pieces: set[str]) -> list[str]:
        older = self.older
        known = [p for p in pieces if p in older]
        self._remember({p: older[p] for p in known})
        return known

    def _forget(self, new: set[str]) -> None:
        """Keeps the memory within its bound; long pieces go at once."""
        if self.held[0] > MEMO_BYTES:
            self.older.clear()
            self.older.update(self.memo)
            self.memo.clear()
            self.memo[""] = b""
            self.held[0] = 0
        for piece in [p for p in new if len(p) > MEMO_CHARS]:
            self.memo.pop(piece, None)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text."""
        memo, out, late = self.memo, [], []
        for t in texts:
            # lower case makes pieces alike, but must not turn text into the name of a special token
            t = t.lower() if "<|" not in t and (t.isascii() or not _ODD.search(t)) else t
            pieces = t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            try:
                out.append(b"".join(map(memo.__getitem__, pieces)))
            except KeyError:
                late.append((len(out), pieces))
                out.append(b"")
        if late:
            new = set().union(*(pieces for _, pieces in late)).difference(memo)
            new.difference_update(self._take_over(new))
            cut = {p: [p] if _ONE_WORD(p) else _PARTS.findall(p) for p in new}
            parts = set().union(*cut.values()).difference(memo)
            parts.difference_update(self._take_over(parts))
            self.learn(parts)
            self._remember({p: b"".join(map(memo.__getitem__, own)) for p, own in cut.items() if p not in parts})
            for i, pieces in late:
                out[i] = b"".join(map(memo.__getitem__, pieces))
            self._forget(new | parts)
        return out


def public_tokenizer(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenize(documents: DataFrame, path: str, end: int = END, keep: str = "doc_id") -> DataFrame:
    """``keep``, ``part``, ``local`` (ids before the document in its partition), ``ids`` (little-endian, 4 bytes each)."""
    key_type = documents.schema[keep].dataType
    ids = documents.select(F.col(keep).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    close = np.asarray([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, offset = WordTokenizer(path), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                ids = [b + close for b in own.encode(part.column(1).to_pylist())]
                counts = np.fromiter((len(b) // 4 for b in ids), np.int64, len(ids))
                local = offset + np.cumsum(counts) - counts
                offset += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(local), pa.array(ids, pa.binary())], names=["key", "local", "ids"]
                )

    rows = ids.mapInArrow(run, f"key {key_type.simpleString()}, local long, ids binary")
    return rows.select(F.col("key").alias(keep), F.spark_partition_id().alias("part"), "local", "ids")


def pack(documents: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """Pieces: ``doc_id``, ``start``, ``piece`` (ids as bytes), ``doc_tokens``, ``sequence_id``, ``offset``."""
    path = path or public_tokenizer()
    tokens = materialise(tokenize(documents, path, end), "tokens")
    totals = tokens.groupBy("part").agg(F.shiftright(F.sum(F.octet_length("ids").cast("long")), 2).alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # one row per input partition
    base = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    key = tokens.schema["doc_id"].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.asarray(batch.column(1)) + np.asarray(batch.column(2))
            row, start, piece, seq, off, total = [], [], [], [], [], []
            for k, (begin, raw) in enumerate(zip(at.tolist(), batch.column(3))):
                raw = raw.as_py()
                n = len(raw) // 4
                done = 0
                while done < n:
                    s, o = divmod(begin + done, length)
                    size = min(length - o, n - done)
                    row.append(k)
                    start.append(done)
                    piece.append(raw[4 * done : 4 * (done + size)])
                    seq.append(s)
                    off.append(o)
                    total.append(n)
                    done += size
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()),
                 pa.array(piece, pa.binary()), pa.array(total, pa.int64()), pa.array(seq, pa.int64()),
                 pa.array(off, pa.int64())],
                names=["doc_id", "start", "piece", "doc_tokens", "sequence_id", "offset"],
            )

    placed = tokens.join(F.broadcast(base), "part").select("doc_id", "local", "base", "ids")
    return placed.mapInArrow(
        cut, f"doc_id {key.simpleString()}, start long, piece binary, doc_tokens long, sequence_id long, offset long"
    )


def sequences(pieces: DataFrame, length: int = LENGTH, pad: int = 0) -> DataFrame:
    """One row per window: ``sequence_id``, ``ids`` padded to ``length`` and the border of each piece.

    A window holds at most ``length`` pieces, which bounds the gathering.
    """
    inside = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "piece"))).alias("p")
    rows = pieces.groupBy("sequence_id").agg(inside)
    fill = bytearray(np.asarray([pad], "<u4").tobytes() * length)
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["piece"]))
    return rows.select(
        "sequence_id", F.substring(F.concat(joined, F.lit(fill)), 1, 4 * length).alias("ids"),
        F.transform("p", lambda x: F.struct(x["doc_id"], x["start"], x["offset"])).alias("borders"),
    )

