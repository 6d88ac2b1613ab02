"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed against it into
phrases: from where the last phrase ended, the longest match that the automaton has. The fewer phrases
a text needs for its length, the closer it is to the language (Ziv-Merhav cross parsing).

The automaton is held as a table of transitions in which a missing one leads back through the root and
counts a phrase, so many rows of bytes are parsed in step with array operations. Texts are parsed in
rows of `ROW` bytes, each from the root; every byte of a text counts.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held, mapped

#: Bytes of labelled text per language that its automaton is built of: a bounded sample, the documents
#: with the smallest hashes of their ids.
SAMPLE_BYTES = 40_000
#: Documents per language that the sample is drawn from, about.
SAMPLE_DOCS = 64
#: Bytes parsed from the root, and rows of them at once.
ROW, ROWS = 512, 8192
HELD_OUT = 5


def held_out(id_col: str = "doc_id") -> F.Column:
    """Whether crc32 of the id as text leaves no remainder by 5; these documents are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_OUT == 0, F.lit(True))


def suffix_automaton(text: bytes, width: int) -> array:
    """The smallest automaton that accepts all substrings of `text`, whose symbols are below `width`: a row
    of `width` next states per state, 0 (the root, where no transition leads) for none."""
    none = array("i", [0]) * width
    go, link, size, last = array("i", none), [-1], [0], 0
    for c in text:
        new = len(size)
        go.extend(none)
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and not go[p * width + c]:
            go[p * width + c] = new
            p = link[p]
        if p >= 0:
            q = go[p * width + c]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                copy = len(size)
                go.extend(go[q * width : (q + 1) * width])
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p * width + c] == q:
                    go[p * width + c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return go


class CrossParser:
    """Phrase counts of texts against each language's sample.

    A language's symbols are the bytes of its sample; any other byte can't be matched and is the last one.
    """

    def __init__(self, samples: dict[str, bytes]) -> None:
        self.langs = sorted(samples)
        self.symbols, self.tables = [], []
        for lang in self.langs:
            text = np.frombuffer(_folded(samples[lang]), np.uint8)
            known = np.unique(text)
            symbol = np.full(256, len(known), np.uint16)
            symbol[known] = np.arange(len(known))
            self.symbols.append(symbol)
            self.tables.append(self._table(symbol[text].astype(np.uint8).tobytes(), len(known) + 1))

    def _table(self, text: bytes, width: int) -> np.ndarray:
        """By state and symbol: the next state's row << 1, plus 1 if a phrase ends before the symbol."""
        go = np.frombuffer(suffix_automaton(text, width), np.int32).reshape(-1, width)
        lost = len(go)  # behind a symbol that the sample lacks, which is a phrase of its own
        root = np.where(go[0] > 0, go[0], lost).astype(np.int32)
        table = np.empty((lost + 1, width), np.int32)
        table[:lost] = np.where(go > 0, go * width << 1, (root * width << 1 | 1)[None, :])
        table[lost] = root * width << 1 | 1
        table[0] = root * width << 1  # the first phrase is counted already
        return table.ravel()

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text (rows) against each language (columns)."""
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        if not self.langs:
            return out
        owner = np.repeat(np.arange(len(texts)), [-(-len(t) // ROW) for t in texts])
        raw = np.frombuffer(b"".join(t.ljust(-(-len(t) // ROW) * ROW, b"\0") for t in texts), np.uint8).reshape(-1, ROW)
        size = np.concatenate([np.minimum(ROW, len(t) - np.arange(0, len(t), ROW)) for t in texts]) if len(owner) else np.zeros(0, int)
        order = np.argsort(-size, kind="stable")  # full rows first: the rows still going are a prefix
        for at in range(0, len(order), ROWS):
            rows = order[at : at + ROWS]
            columns = np.ascontiguousarray(raw[rows].T)
            going = np.searchsorted(-size[rows], -np.arange(1, ROW + 1), "right")
            for lang, (symbol, table) in enumerate(zip(self.symbols, self.tables, strict=True)):
                codes = symbol[columns]
                state, count = np.zeros(len(rows), np.int32), np.ones(len(rows), np.int32)
                for step in range(int(size[rows[0]])):
                    n = going[step]
                    now = table[state[:n] + codes[step, :n]]
                    count[:n] += now & 1
                    state[:n] = now >> 1
                out[:, lang] += np.bincount(owner[rows], count, len(texts)).astype(np.int64)
        return out

    def decide(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; ties go to the first language by name."""
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t and self.langs and any(map(str.isalpha, t))]
        if known:
            folded = [_folded(texts[i].encode("utf-8", "surrogatepass")) for i in known]
            per_byte = self.phrases(folded) / np.array([len(t) for t in folded])[:, None]
            best = per_byte.argmin(axis=1)
            # the share of the best in the languages' closeness, 1 / phrases a byte, to the 4th power
            close = (per_byte[np.arange(len(best)), best][:, None] / per_byte) ** 4
            for i, b, s in zip(known, best.tolist(), (1 / close.sum(axis=1)).tolist(), strict=True):
                langs[i], scores[i] = self.langs[b], s
        return langs, scores


def _folded(text: bytes) -> bytes:
    """The words: A-Z lower-cased, other ASCII bytes than letters as single spaces."""
    return b" ".join(text.lower().translate(_TO_SPACE).split())


_TO_SPACE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_bytes: int = SAMPLE_BYTES, sample_docs: int = SAMPLE_DOCS) -> dict[str, bytes]:
    """Sample text by language, at most `sample_bytes` each.

    Every label with a non-empty text is learned. Which documents are taken depends on the hashes of
    their ids alone: the smallest ones, until they fill the bound. All languages are read in one pass:
    those below a threshold that follows from the language's count, about 2 * `sample_docs` each.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang IS NOT NULL AND text <> ''")
    rows = rows.withColumn("rank", F.pmod(F.xxhash64("id", F.lit(SAMPLE_DOCS)), F.lit(1 << 30)))
    # the text is cut to the bound here, where it is learned from; predictions read whole texts
    rows = rows.withColumn("text", F.substring("text", 1, sample_bytes))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    limits = [(lang, int((1 << 30) * min(1.0, 2 * sample_docs / n))) for lang, n in counts.items()]
    few = rows.join(F.broadcast(labelled.sparkSession.createDataFrame(limits, "lang string, below long")), "lang").filter("rank < below")
    place = Window.partitionBy("lang").orderBy("rank", "id")
    few = few.withColumn("n", F.row_number().over(place)).filter(F.col("n") <= sample_docs)
    # what stands before a text in its language's sample; a text that begins beyond the bound isn't needed
    before = F.coalesce(F.sum(F.octet_length("text") + 1).over(place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    samples: dict[str, bytes] = {}
    for r in few.withColumn("before", before).filter(F.col("before") < sample_bytes).select("lang", "n", "text").orderBy("lang", "n").collect():
        text = r["text"].encode("utf-8", "surrogatepass")
        samples[r["lang"]] = samples[r["lang"]] + b"\n" + text if r["lang"] in samples else text
    if lost := sorted(counts.keys() - samples.keys()):  # no id of a frequent language below its threshold
        first = rows.filter(F.col("lang").isin(lost)).groupBy("lang").agg(F.min_by("text", F.struct("rank", "id")).alias("text"))
        samples |= {r["lang"]: r["text"].encode("utf-8", "surrogatepass") for r in first.collect()}
    return {lang: samples[lang][:sample_bytes] for lang in sorted(samples)}


def _parser(samples: dict[str, bytes]) -> CrossParser:
    """One per sample and worker process."""
    return held(("parser", *sorted(samples.items())), lambda: CrossParser(samples))


def _decided(parser: CrossParser, column: pa.Array) -> tuple[list[str], list[float]]:
    langs, scores, group, size = [], [], [], 0
    for i, text in enumerate(column):
        group.append(text.as_py())
        size += len(group[-1] or "")
        if size > 4_000_000 or i + 1 == len(column):
            a, b = parser.decide(group)
            langs += a
            scores += b
            group, size = [], 0
    return langs, scores


def predict(df: DataFrame, samples: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, whole texts read.

    ``und`` with score 0 if the text is null, empty or has no letter, or if nothing was learned. The
    score lies between 0 and 1 and is the best language's share of closeness; with one language it is
    1. A null id counts as held out. Texts of any length are parsed to their end, equal closeness goes to
    the first language by name. Repeated rows come out each, no rows give none; other columns, language
    and source too, are not read.
    """
    kind = df.schema[id_col].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(shared.value)
        for batch in batches:
            langs, scores = _decided(parser, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = df.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return mapped(rows, run, f"doc_id {kind}, held_out boolean, lang_pred string, score double", holds=True)


def keep_known(df: DataFrame, samples: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """The rows of `df` whose text is in one of the learned languages, that is, not ``und``: null and empty
    texts and those without a letter go, repeated rows stay each. Columns of any name are handed on."""
    shared = df.sparkSession.sparkContext.broadcast(samples)
    at = df.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(shared.value)
        for batch in batches:
            yield batch.filter(pa.array([x != "und" for x in _decided(parser, batch.column(at))[0]], pa.bool_()))

    return mapped(df, run, df.schema, holds=True)


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """`predict` for `df`, learned from its own rows that are not held out."""
    return predict(df, learn(df.filter(~held_out(id_col)), id_col, text_col, lang_col), id_col, text_col)
