"""Quality rules by tokeniser fertility.

A public subword vocabulary is a cheap language model: text it was made for splits into few, varied
tokens; junk splits into single characters or raw bytes, and spam repeats few tokens. Per document
three figures are measured over all words: characters per token, share of byte-fallback tokens and
entropy of the token histogram. Each language (or, for an unknown one, each script) has a band.

Defined results: a null or empty text has no words and fails the base rule; ties do not occur;
repeated rows are judged alike, each on its own; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .registry import query

MODEL = "piece_bpe_32k.model"
CACHE_WORDS = 400_000  # token lists a task remembers; it starts anew beyond that, results do not change
BYTE = 6  # piece type of byte fallback in the vocabulary file
MIN_WORDS, MAX_REPEAT = 20, 30


@dataclass(frozen=True)
class Band:
    """What a document must show to be kept; entropy is asked for as a share of what is possible."""
    chars_low: float
    chars_high: float
    bytes_high: float
    entropy_low: float  # of log2(min(tokens, pieces of the vocabulary))


# Bands per language, then per script for languages not listed. Real prose lies well inside: a
# word list, number dump or encoded blob falls out at the low end of characters per token, a text
# of few repeated words at the low end of entropy.
LANGUAGE_BANDS = {
    "en": Band(1.6, 7.0, 0.05, 0.45),
    "de": Band(1.4, 7.0, 0.05, 0.45),
    "fr": Band(1.3, 7.0, 0.05, 0.45),
    "es": Band(1.3, 7.0, 0.05, 0.45),
}
SCRIPT_BANDS = {
    "latin": Band(1.3, 8.0, 0.10, 0.40),
    "other": Band(0.25, 4.0, 0.80, 0.35),
}


class _Words:
    """Token lists of distinct words by their 64-bit hash, appended to one flat array."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = self.model.vocab_size()
        self.is_byte = np.array([self.model.is_byte(i) or self.model.is_unknown(i) for i in range(self.pieces)])
        self.reset()

    def reset(self) -> None:
        self.place: dict[int, int] = {}
        self.starts, self.tokens = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def rows(self, hashes: np.ndarray, texts_of) -> np.ndarray:
        """Row of each distinct hash; `texts_of(places)` gives the words that are new."""
        if len(self.place) > CACHE_WORDS:
            self.reset()
        place = self.place
        found = [place.get(h, -1) for h in hashes.tolist()]
        new = [i for i, row in enumerate(found) if row < 0]
        if new:
            lists = self.model.encode(texts_of(new), num_threads=1)
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            first = len(self.starts) - 1
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
            self.tokens = np.concatenate([self.tokens, np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))])
            place.update(zip(hashes[new].tolist(), range(first, first + len(new))))
            found = np.asarray(found, np.int64)
            found[new] = np.arange(first, first + len(new))
        return np.asarray(found, np.int64)


def gather(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the items of `rows` in a flat array with row starts, and each row's count."""
    counts = starts[rows + 1] - starts[rows]
    total = int(counts.sum())
    shift = np.repeat(starts[rows] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    return np.arange(total) + shift, counts


def measure(buf: np.ndarray, offsets: np.ndarray, words: _Words) -> dict[str, np.ndarray]:
    """The figures of every document of one slice."""
    n = len(offsets) - 1
    starts, ends, rows = common.word_spans(buf, offsets)
    sums = common.prefix_hash(buf)
    hashes = common.range_hash(sums, starts, ends)
    out = {"n_words": np.bincount(rows, minlength=n).astype(np.int64)}
    points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    out["word_chars"] = np.bincount(rows, points[ends] - points[starts], n).astype(np.int64)
    symbol = np.zeros(256, bool)
    symbol[list(b"#*$%&|<>")] = True
    symbols = np.concatenate([[0], np.cumsum(symbol[buf])])
    out["n_symbols"] = symbols[offsets[1:]] - symbols[offsets[:-1]]
    out["n_dup_lines"] = _dup_lines(buf, offsets, sums, starts, n)
    out["n_repeat_words"] = _repeat_words(hashes, rows, n)

    distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    place = words.rows(distinct, lambda new: [
        w.decode("utf-8", "replace") for w in common.strings(buf, starts[first[new]], ends[first[new]])])
    at, counts = gather(words.starts, place[inverse])
    tokens = words.tokens[at]
    doc = np.repeat(rows, counts)
    out["n_tokens"] = np.bincount(doc, minlength=n).astype(np.int64)
    fallback = np.bincount(doc[words.is_byte[tokens]], minlength=n)
    key, times = np.unique(doc * words.pieces + tokens, return_counts=True)
    total = np.maximum(out["n_tokens"], 1)
    share = times / total[key // words.pieces]
    out["token_entropy"] = np.bincount(key // words.pieces, -share * np.log2(share), n) + 0.0
    out["chars_per_token"] = out["word_chars"] / total
    out["byte_share"] = fallback / total
    letters = np.concatenate([[0], np.cumsum(buf < 0x80)])
    out["ascii"] = letters[offsets[1:]] - letters[offsets[:-1]]
    out["bytes"] = np.diff(offsets)
    return out


def _dup_lines(buf, offsets, sums, word_starts, n) -> np.ndarray:
    """Lines with a word that equal an earlier line of the document."""
    breaks = np.flatnonzero(buf == 10)
    begin = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    begin = begin[begin < len(buf)]
    if not len(begin):
        return np.zeros(n, np.int64)
    rows = np.searchsorted(offsets, begin, side="right") - 1
    end = np.minimum(np.concatenate([begin[1:], [len(buf)]]), offsets[rows + 1])
    end = end - ((end > begin) & (buf[np.maximum(end - 1, 0)] == 10))
    words = np.searchsorted(word_starts, end) - np.searchsorted(word_starts, begin)
    held = words > 0
    keys = common.mix(common.range_hash(sums, begin[held], end[held]) + common.mix(rows[held]))
    _, first = np.unique(keys, return_index=True)
    lines = np.bincount(rows[held], minlength=n)
    return lines - np.bincount(rows[held][first], minlength=n)


def _repeat_words(hashes: np.ndarray, rows: np.ndarray, n: int, size: int = 8) -> np.ndarray:
    """Words covered by windows of `size` words that occur twice or more in their document."""
    windows = common.window_hashes(hashes, size)
    if not len(windows):
        return np.zeros(n, np.int64)
    inside = np.flatnonzero(rows[: len(windows)] == rows[size - 1:])
    keys = common.mix(windows[inside] + common.mix(rows[inside]))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(hashes) + 1, np.int64)
    hit = inside[twice]
    np.add.at(step, hit, 1)
    np.add.at(step, hit + size, -1)
    return np.bincount(rows[np.cumsum(step[:-1]) > 0], minlength=n).astype(np.int64)


def verdicts(m: dict[str, np.ndarray], langs: list) -> tuple[np.ndarray, np.ndarray, list]:
    """base_failed, kept and the reason of each document."""
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT * m["n_words"])
    kept, reasons = ~failed, []
    for i, lang in enumerate(langs):
        script = "latin" if 2 * m["ascii"][i] >= m["bytes"][i] else "other"
        band = LANGUAGE_BANDS.get(lang) or SCRIPT_BANDS[script]
        most = np.log2(max(2.0, min(float(m["n_tokens"][i]), 32_000.0)))
        why = "base" if failed[i] else None
        if why is None and not band.chars_low <= m["chars_per_token"][i] <= band.chars_high:
            why = "chars_per_token"
        if why is None and m["byte_share"][i] > band.bytes_high:
            why = "byte_share"
        if why is None and m["token_entropy"][i] < band.entropy_low * most:
            why = "token_entropy"
        kept[i] = why is None
        reasons.append(why)
    return failed, kept, reasons


LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")
DOUBLES = ("chars_per_token", "byte_share", "token_entropy")
FIGURES = (", ".join(f"{c} long" for c in LONGS) + ", " + ", ".join(f"{c} double" for c in DOUBLES)
           + ", base_failed boolean, kept boolean, reason string")


def _figures(batch: pa.RecordBatch, text: int, lang: int, words: _Words) -> list[pa.Array]:
    buf, offsets = common.text_buffer(batch.column(text))
    langs = batch.column(lang).to_pylist()
    parts = []
    for i, j in common.row_slices(offsets):
        m = measure(buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i], words)
        failed, kept, reasons = verdicts(m, langs[i:j])
        parts.append([m[c] for c in LONGS] + [m[c] for c in DOUBLES] + [failed, kept, reasons])
    columns = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in range(11)]
    reason = [r for p in parts for r in p[11]]
    kinds = [pa.int64()] * 6 + [pa.float64()] * 3 + [pa.bool_()] * 2
    return [pa.array(c).cast(k) for c, k in zip(columns, kinds)] + [pa.array(reason, pa.string())]


def rate(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and all figures with the verdict, one row per row of `docs` (doc_id, text, lang)."""
    import public_tokenizers
    path = model or public_tokenizers.path(MODEL)

    def run(batches):
        words = _Words(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *_figures(batch, 1, 2, words)],
                names=["doc_id", *LONGS, *DOUBLES, "base_failed", "kept", "reason"])

    return docs.select("doc_id", "text", "lang").mapInArrow(run, f"doc_id long, {FIGURES}")


def keep_good(docs: DataFrame, model: str | None = None) -> DataFrame:
    """The rows of `docs` that pass, all columns unchanged: one pass, no shuffle."""
    import public_tokenizers
    path = model or public_tokenizers.path(MODEL)
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches):
        words = _Words(path)
        for batch in batches:
            yield batch.filter(_figures(batch, text, lang, words)[10])

    return docs.mapInArrow(run, docs.schema)


@query("op1_quality_rules")
def op1_quality_rules(spark, sf_dir):
    common.small_batches(spark)
    return rate(common.table(spark, sf_dir, "documents"))
