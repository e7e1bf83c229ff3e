"""Quality rules (operator 8): base counts, and Jensen-Shannon distance to language references.

References come from all documents: for each language (value of the language column) of at least ``REFERENCE_WORDS``
words, and for all texts together, the share of each character class and of each of the ``COMMON`` most frequent words
(and of all others together). Classes are those of Unicode, whatever the script. A document is compared with every
reference of its own script and its smallest distances count, so a wrong or missing language label harms no document.
The distances judge only texts of at least ``MIN_CHARS`` characters and ``MIN_WORDS`` words (the guard): shorter
histograms are noise; and only where a reference of the text's script exists: nothing is known about others. A document
is kept if the base rules pass and neither distance exceeds its limit.

Defined results: a null or empty text has no words and fails the base rules; a language that is null or has less text
counts towards the reference of all texts only; equal rows give equal results; extra columns are ignored; an empty
table gives an empty result. Texts are counted whole.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.common import Scratch, by_value, texts, tidy
from terrane.llm.packing import slices

by_value(__name__)

ALL, OTHER = "", "*"
#: Words that a language needs for a reference of its own, and references at most (the languages of most words).
REFERENCE_WORDS, REFERENCES = 5_000, 1_000
COMMON = 50
#: Parts of a reference's words whose commonest are found apart.
PARTS = 32
MIN_WORDS, MIN_CHARS = 50, 200
MAX_CHAR_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.45
#: Base rules.
BASE_MIN_WORDS, BASE_MAX_REPEATED = 50, 0.5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

CLASSES = ("lower", "upper", "digit", "space", "line end", "sentence mark", "symbol", "other mark", "letter")


def _class_of(c: int) -> int:
    ch = chr(c)
    if ch == "\n":
        return 4
    if ch.isspace():
        return 3
    if ch.isdigit():
        return 2
    if ch.isalpha():
        return 0 if ch.islower() else 1 if ch.isupper() else 8
    if unicodedata.category(ch) in ("Mn", "Mc"):  # vowel signs and accents belong to letters
        return 8
    if ch in ".,;:?!'\"()-\u2010\u2011\u2012\u2013\u2014\u2018\u2019\u201c\u201d\u2026\u3001\u3002\uff0c\u0964\u060c\u061f":
        return 5
    return 6 if ch in SYMBOLS + "@^~{}[]\\_=+/`" else 7


#: Class of each character of the basic plane; the others count as letters without case.
CLASS_TABLE = np.array([_class_of(c) for c in range(0x10000)], np.uint8)
#: Scripts by ranges of code points; other letters are of no script here.
SCRIPTS = {"LATIN": [(0x41, 0x24F), (0x1E00, 0x1EFF)], "GREEK": [(0x370, 0x3FF), (0x1F00, 0x1FFF)], "CYRILLIC": [(0x400, 0x52F)],
           "ARMENIAN": [(0x530, 0x58F)], "HEBREW": [(0x590, 0x5FF)], "ARABIC": [(0x600, 0x6FF), (0x750, 0x77F)], "DEVANAGARI": [(0x900, 0x97F)],
           "BENGALI": [(0x980, 0x9FF)], "TAMIL": [(0xB80, 0xBFF)], "THAI": [(0xE00, 0xE7F)], "GEORGIAN": [(0x10A0, 0x10FF)],
           "KANA": [(0x3040, 0x30FF)], "CJK": [(0x3400, 0x9FFF)], "HANGUL": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)]}
SCRIPT_NAMES = ("", *SCRIPTS)
SCRIPT_TABLE = np.zeros(0x10000, np.uint8)
for _k, _ranges in enumerate(SCRIPTS.values(), 1):
    for _low, _high in _ranges:
        SCRIPT_TABLE[_low:_high + 1] = _k
SCRIPT_TABLE[~np.isin(CLASS_TABLE, (0, 1, 8))] = 0
#: For the common-word histograms A-Z become small, ASCII marks other than SYMBOLS become spaces.
PLAIN_BYTES = bytes(c if c > 127 or chr(c) in SYMBOLS else ord(chr(c).lower()) if chr(c).isalnum() else 32
                    for c in range(256))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def class_counts(text: str) -> np.ndarray:
    codes = _codes(text)
    low = codes[codes < len(CLASS_TABLE)]
    counts = np.bincount(CLASS_TABLE[low], minlength=len(CLASSES))
    counts[8] += len(codes) - len(low)
    return counts


def script_counts(text: str) -> np.ndarray:
    """Letters by script, in the order of SCRIPT_NAMES (the first: no script)."""
    if text.isascii():
        return np.bincount([1], minlength=len(SCRIPT_NAMES)) * sum(map(str.isalpha, text))
    codes = _codes(text)
    counts = np.bincount(SCRIPT_TABLE[codes[codes < len(SCRIPT_TABLE)]], minlength=len(SCRIPT_NAMES))
    counts[0] = 0
    return counts


def main_script(counts: np.ndarray) -> str:
    return SCRIPT_NAMES[int(counts.argmax())] if counts.any() else ""


def script_of(text: str) -> str:
    return main_script(script_counts(text))


def plain_words(text: bytes) -> list[bytes]:
    """Words as the common-word histograms take them: a symbol inside a word keeps it from being a common one."""
    return text.translate(PLAIN_BYTES).split()


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur at least twice in the text."""
    if len(words) <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    key = ids
    for k in range(1, width):  # windows of k + 1 words get dense numbers
        key = key[:-1] * len(number) + ids[k:]
        key = np.unique(key, return_inverse=True)[1]
    again = np.bincount(key)[key] > 1
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[k:len(again) + k] |= again
    return int(covered.sum())


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words))


def js_distances(p: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Square roots of the Jensen-Shannon divergences (base 2) of histogram p, or one per row, to the rows of refs.

    0 for equal histograms, 1 for disjoint or empty ones.
    """
    p, refs = np.broadcast_arrays(p.astype(float), refs.astype(float))
    sums, ref_sums = p.sum(axis=1, keepdims=True), refs.sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        p, q = p / sums, refs / ref_sums
        m = (p + q) / 2
        terms = np.where(p > 0, p * np.log2(p / m), 0.0) + np.where(q > 0, q * np.log2(q / m), 0.0)
    return np.where((sums * ref_sums)[:, 0] > 0, np.sqrt(np.clip(terms.sum(axis=1) / 2, 0, 1)), 1.0)


def references(docs: DataFrame, common: int = COMMON, text_col: str = "text", lang_col: str = "lang") -> dict:
    """Per reference: class histogram, script, and {word: count} of the commonest words with the count of all words.

    Counts cover all documents; what reaches the driver is bounded by references x (classes + scripts + common words).
    """
    lang = F.coalesce(F.nullif(F.col(lang_col).cast("string"), F.lit(ALL)), F.lit(OTHER))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            classes: dict[str, np.ndarray] = {}
            scripts: dict[str, np.ndarray] = {}
            words: dict[str, Counter] = {}
            for own, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                classes[own] = classes.get(own, 0) + class_counts(text)
                scripts[own] = scripts.get(own, 0) + script_counts(text)
                words.setdefault(own, Counter()).update(plain_words(text.encode()))
            for own in classes:
                total = sum(words[own].values())
                found = [(f"w{w.decode()}", n) for w, n in words[own].items()]
                found += [(f"c{k}", int(n)) for k, n in enumerate(classes[own])] + [("n", total)]
                found += [(f"s{k}", int(n)) for k, n in enumerate(scripts[own]) if n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own] * len(found), pa.string()), pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.int64())], names=["ref", "item", "n"])

    counted = (docs.select(lang.alias("ref"), F.col(text_col).alias("text"))
               .mapInArrow(tidy(count, "quality"), "ref string, item string, n long")
               .groupBy("ref", "item").agg(F.sum("n").alias("n")))
    counted = Scratch(docs.sparkSession, "quality").write(counted, "counts")
    named = counted.where((F.col("item") == "n") & (F.col("ref") != OTHER) & (F.col("n") >= REFERENCE_WORDS)).orderBy(F.desc("n"), "ref").limit(REFERENCES)
    whole = counted.groupBy(F.lit(ALL).alias("ref"), "item").agg(F.sum("n").alias("n"))
    most = max(common, len(CLASSES), len(SCRIPT_NAMES))
    kind = F.substring("item", 1, 1)
    every = counted.join(named.select("ref"), "ref", "left_semi").unionByName(whole)
    # the commonest of each part, then of all parts: one reference is no single task's
    part = Window.partitionBy("ref", kind, F.pmod(F.xxhash64("item"), F.lit(PARTS))).orderBy(F.desc("n"), "item")
    window = Window.partitionBy("ref", kind).orderBy(F.desc("n"), "item")
    top = every.withColumn("k", F.row_number().over(part)).where(F.col("k") <= most)
    top = top.withColumn("k", F.row_number().over(window)).where(F.col("k") <= most)
    out: dict[str, dict] = {}
    for row in top.collect():
        own = out.setdefault(row["ref"], {"classes": np.zeros(len(CLASSES)), "scripts": np.zeros(len(SCRIPT_NAMES)), "words": Counter(), "n": 0})
        item = row["item"]
        if item[0] == "c":
            own["classes"][int(item[1:])] = row["n"]
        elif item[0] == "s":
            own["scripts"][int(item[1:])] = row["n"]
        elif item[0] == "n":
            own["n"] = row["n"]
        elif row["k"] <= common:
            own["words"][item[1:].encode()] = row["n"]
    for own in out.values():
        own["words"] = dict(sorted(own["words"].items(), key=lambda x: (-x[1], x[0])))
        own["script"] = main_script(own.pop("scripts"))
    return {r: out[r] for r in sorted(out) if out[r]["n"]}


class Judge:
    """Distances of a text to the nearest reference."""

    def __init__(self, refs: dict):
        self.vocabulary: dict[bytes, int] = {}
        widest = max((len(own["words"]) for own in refs.values()), default=0)
        self.classes = np.array([own["classes"] for own in refs.values()]).reshape(-1, len(CLASSES))
        #: per reference: places of its words in the vocabulary (an unused place fills up), their counts, the rest
        self.places = np.full((len(refs), widest), -1)
        self.shares = np.zeros((len(refs), widest + 1))
        for r, own in enumerate(refs.values()):
            for k, (word, n) in enumerate(own["words"].items()):
                self.places[r, k] = self.vocabulary.setdefault(word, len(self.vocabulary))
                self.shares[r, k] = n
            self.shares[r, -1] = own["n"] - self.shares[r, :-1].sum()
        self.scripts = np.array([own["script"] for own in refs.values()])

    def distances(self, text: str, encoded: bytes) -> tuple[float, float] | None:
        """To the nearest reference of the text's script; None if there is none."""
        fits = self.scripts == script_of(text)
        if not fits.any():
            return None
        words = plain_words(encoded)
        found = [k for k in map(self.vocabulary.get, words) if k is not None]
        counted = np.bincount(found, minlength=len(self.vocabulary) + 1)  # the last place, -1, stays 0
        common = counted[self.places[fits]]
        histograms = np.column_stack([common, len(words) - common.sum(axis=1)])
        return (float(js_distances(class_counts(text)[None, :], self.classes[fits]).min()),
                float(js_distances(histograms, self.shares[fits]).min()))


def score_quality(docs: DataFrame, refs: dict, max_char_distance: float = MAX_CHAR_DISTANCE,
                  max_word_distance: float = MAX_WORD_DISTANCE, id_col: str = "doc_id", text_col: str = "text",
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """Counts, distances and decisions of every document; ``carry`` names input columns to pass on as they are."""
    source = docs.select(F.col(text_col).alias("text"), F.struct(id_col, *carry).alias("row"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(refs)
        for batch in batches:
            out = []
            for text in texts(batch.column(0)):
                encoded = text.encode()
                words = encoded.split()
                counts = base_counts(text, words)
                failed = len(words) < BASE_MIN_WORDS or counts[3] > BASE_MAX_REPEATED * len(words)
                found = judge.distances(text, encoded)
                judged = found is not None and len(words) >= MIN_WORDS and len(text) >= MIN_CHARS
                kept = not failed and not (judged and (found[0] > max_char_distance or found[1] > max_word_distance))
                out.append((len(words), *counts, failed, kept, *(found or (None, None))))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *(pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds))],
                names=["row", *names, "base_failed", "kept", "char_distance", "word_distance"])

    return source.mapInArrow(tidy(score, "quality"), f"row {source.schema['row'].dataType.simpleString()}, "
                             + ", ".join(f"{n} long" for n in names)
                             + ", base_failed boolean, kept boolean, char_distance double, word_distance double")
