"""Language identification by compression.

Per language, snippets of training text form a zstandard raw-content dictionary. A text is encoded with every
dictionary and belongs to the language whose dictionary makes it smallest; long texts are encoded in segments, all of
them. A narrow margin between the two smallest sizes marks the answer as rejected.

Training takes a bounded sample: the middle ``SNIPPET`` characters of about ``SNIPPETS`` documents per language, chosen
by a hash of the id, and of these, in the order of that hash, as many as ``dictionary_bytes`` hold. The dictionaries are broadcast: their number is that of
the languages, so their size is bounded by languages times ``dictionary_bytes``. Texts are scanned once, without a
shuffle.

Edge cases: null texts and texts without a letter are ``und`` with score 0. Without a training row everything is
``und``. Ties go to the first language in order. Null languages teach nothing. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import unit_hash

UNDETERMINED = "und"
SNIPPET = 300
SNIPPETS = 400
DICTIONARY_BYTES = 64 << 10
LEVEL = 6
SEGMENT = 1000
MARGIN = 0.01

_OTHER = re.compile(r"[\W\d_]+")


def letters_only(text: str | None) -> bytes:
    """Lower-case words with single spaces around them; nothing if no letter is among them."""
    words = _OTHER.sub(" ", (text or "").lower()).strip()
    return f" {words} ".encode("utf-8", "surrogatepass") if any(map(str.isalpha, words)) else b""


def compressors(dictionaries: dict[str, bytes], level: int) -> dict:
    import zstandard as z

    plain = z.ZstdCompressionParameters(
        compression_level=level, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    return {
        lang: z.ZstdCompressor(
            dict_data=z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=plain
        )
        for lang, content in sorted(dictionaries.items())
    }


def sizes(text: bytes, by_language: dict, segment: int) -> np.ndarray:
    parts = [text[k : k + segment] for k in range(0, len(text), segment)]
    return np.asarray([sum(len(c.compress(p)) for p in parts) for c in by_language.values()])


def train(documents: DataFrame, learn: Column | None = None, snippets: int = SNIPPETS,
          dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionary content per language from documents for which ``learn`` holds."""
    rows = documents.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if learn is not None:
        rows = rows.filter(learn)
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, snippets / n)])
    drawn = rows.filter(unit_hash(F.col("doc_id")) < F.element_at(share, F.col("lang")))
    middle = F.greatest(F.lit(1), F.floor(F.length("text") / 2).cast("int") - SNIPPET // 2)
    snippet = F.substring("text", middle, F.lit(SNIPPET))
    # one snippet per id: an id that repeats without end is still one example
    picked = drawn.groupBy("lang", "doc_id").agg(F.min(snippet).alias("s"))
    picked = picked.select("lang", "s", unit_hash(F.col("doc_id")).alias("h")).collect()
    out: dict[str, bytes] = {}
    for lang in sorted(counts):
        # in the order of the hash: the order of the texts would cut whole scripts away
        drawn_texts = [letters_only(s) for _, s in sorted((r["h"], r["s"]) for r in picked if r["lang"] == lang)]
        out[lang] = b"".join(dict.fromkeys(drawn_texts))[:dictionary_bytes]
    return {lang: content for lang, content in out.items() if len(content) >= 8}


def identify(documents: DataFrame, dictionaries: dict[str, bytes], level: int = LEVEL, segment: int = SEGMENT,
             margin: float = MARGIN) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (0 to 1, by the margin) and ``rejected`` per document."""
    shared = documents.sparkSession.sparkContext.broadcast(dictionaries)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def smallest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = compressors(shared.value, level)
        names = list(known)
        for texts in batches:
            rows = []
            for text in texts:
                body = letters_only(text)
                if not body or not names:
                    rows.append((UNDETERMINED, 0.0, True))
                    continue
                size = sizes(body, known, segment)
                best = int(size.argmin())
                rest = np.delete(size, best)
                gap = 1.0 if not len(rest) else float((rest.min() - size[best]) / rest.min())
                rows.append((names[best], 1.0 if not len(rest) else gap / (gap + margin), gap < margin))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "rejected"])

    return documents.select("doc_id", smallest("text").alias("r")).select("doc_id", "r.*")
