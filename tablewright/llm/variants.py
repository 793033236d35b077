"""Spelling variants: words that differ by one code point, grouped under their most frequent form.

The vocabulary lies in a table; what is broadcast are Bloom filters of it, one per
length of words, in blocks of 512 bits, of a bounded total size. Every word generates
its edits towards shorter words and towards letters further up, each as a hash that
follows from the word's own in a few operations, and probes the filter of the edit's
length. Only edits that pass become rows; an exact join with the vocabulary removes
the false ones. A vocabulary beyond the bound makes more of them, never fewer true ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import importable, stage, unstage

#: Letters of a word: those of Latin-1, each one byte of that encoding.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of the filters for each word, bytes of all of them at most, bits set for a word.
BITS, MOST_BYTES, SET = 24, 32 << 20, 4
#: Generated edits for each task, letters of words worked on at once.
PROBES, AT_ONCE = 20_000_000, 1 << 17
#: Factors of the hashes: any odd numbers without a pattern.
STEP, FIRST, SECOND = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xCA5A826395121157))


def words(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 6, rarest: int = 5, mistype: int | None = None) -> DataFrame:
    """``(word, n)``: runs of letters of the whole texts, only A-Z lower-cased, of ``shortest`` letters and ``rarest`` uses on.

    With ``mistype`` a run loses one letter where that number divides the crc32 of
    ``key:run``; its remainder by the run's length says which. A null key counts as
    empty there; a null or empty text has no words.
    """
    found = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    found = found.where(F.length("run") >= shortest)
    run = F.col("run")
    plain = F.octet_length(run) == F.length(run)  # A to z alone: the fast way
    found = found.select("key", F.when(plain, F.lower(run)).otherwise(F.translate(run, UPPER, LOWER)).alias("word"))
    if mistype:
        hashed = F.crc32(F.concat_ws(":", "key", "word").cast("binary"))
        at = (F.col("h") % F.length("word")).cast("int")
        short = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
        found = found.select("word", hashed.alias("h")).select(F.when(F.col("h") % mistype == 0, short).otherwise(F.col("word")).alias("word"))
        found = found.where(F.length("word") >= shortest)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= rarest)


@dataclass
class Shard:
    """The filter of one length of words: its blocks, the number of its words, their letters."""

    start: int
    blocks: int
    words: int
    letters: np.ndarray


@dataclass
class Filters:
    shards: dict[int, Shard]
    bits: np.ndarray

    def holds(self, length: int, hashed: np.ndarray) -> np.ndarray:
        """Which of the edits of one length may be words."""
        left = np.arange(len(hashed))
        for k in range(SET):
            word, bit = _place(self.shards[length], hashed[left], k)
            left = left[(self.bits[word] >> bit) & np.uint64(1) == 1]
        return left


def _mixed(raw: np.ndarray) -> np.ndarray:
    x = (raw ^ (raw >> np.uint64(32))) * FIRST
    x = (x ^ (x >> np.uint64(29))) * SECOND
    return x ^ (x >> np.uint64(32))


def _place(shard: Shard, hashed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit word of the filters and the bit in it that a hash sets as its ``k``-th."""
    block = (hashed >> np.uint64(40)) * np.uint64(shard.blocks) >> np.uint64(24)
    at = hashed >> np.uint64(9 * k) & np.uint64(511)
    return (np.uint64(shard.start) + block) * np.uint64(8) + (at >> np.uint64(6)), at & np.uint64(63)


def _powers(length: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(length - 1, STEP)]), dtype=np.uint64)


def _letters(found: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length at a time: their numbers, and their letters as bytes."""
    lengths = np.array([len(w) for w in found])
    for length in np.unique(lengths):
        same = np.nonzero(lengths == length)[0]
        for part in np.array_split(same, max(1, len(same) * length // AT_ONCE)):
            raw = "".join(found[k] for k in part).encode("latin-1")
            yield part, np.frombuffer(raw, np.uint8).reshape(len(part), length)


def filters(vocabulary: DataFrame) -> Filters:
    """The filters of a vocabulary, put together by Spark and collected: at most ``MOST_BYTES``."""
    lengths = vocabulary.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("words"))
    letters = (
        vocabulary.select(F.length("word").alias("length"), F.explode(F.array_distinct(F.split("word", ""))).alias("letter"))
        .where("letter <> ''").distinct().groupBy("length").agg(F.array_join(F.sort_array(F.collect_list("letter")), "").alias("letters"))
    )
    rows = sorted(lengths.join(letters, "length").collect(), key=lambda r: r["length"])
    per_word = min(BITS, 8 * MOST_BYTES / max(1, sum(r["words"] for r in rows)))
    shards, start = {}, 0
    for row in rows:
        blocks = int(row["words"] * per_word / 512) + 1
        shards[row["length"]] = Shard(start, blocks, row["words"], np.frombuffer(row["letters"].encode("latin-1"), np.uint8))
        start += blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, mask = [], []
            for _, letters in _letters(batch.column(0).to_pylist()):
                length = letters.shape[1]
                hashed = _mixed((letters * _powers(length)).sum(axis=1, dtype=np.uint64))
                for k in range(SET):
                    word, bit = _place(shards[length], hashed, k)
                    at.append(word)
                    mask.append(np.uint64(1) << bit)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, np.uint64), *x]).view(np.int64), pa.int64()) for x in (at, mask)], names=["at", "mask"]
            )

    set_bits = vocabulary.select("word").mapInArrow(run, "at long, mask long").groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(8 * start, np.uint64)
    bits[set_bits["at"].to_numpy()] = set_bits["mask"].to_numpy().view(np.uint64)
    return Filters(shards, bits)


def _edits(letters: np.ndarray, known: Filters) -> Iterator[tuple[int, bytes]]:
    """Edits of words of one length that pass a filter: the word's row and the edit.

    Each pair of near words comes up once: from the longer one, or from the one whose
    letter is the lower.
    """
    length = letters.shape[1]
    powers = _powers(length)
    parts = letters * powers
    whole = parts.sum(axis=1, dtype=np.uint64)
    own, less = known.shards[length], known.shards.get(length - 1)
    if own.words > 1:
        for letter in own.letters:
            row, at = np.nonzero(letters < letter)
            raw = whole[row] + (np.uint64(letter) - letters[row, at]) * powers[at]
            for k in known.holds(length, _mixed(raw)):
                edit = bytearray(letters[row[k]].tobytes())
                edit[at[k]] = letter
                yield int(row[k]), bytes(edit)
    if less:
        before = np.cumsum(parts, axis=1, dtype=np.uint64) - parts
        moved = np.zeros_like(parts)
        moved[:, 1:] = letters[:, 1:] * powers[:-1]
        after = moved.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
        last = np.ones(letters.shape, bool)
        last[:, :-1] = letters[:, :-1] != letters[:, 1:]  # any letter of a run of equal ones gives the same edit
        row, at = np.nonzero(last)
        for k in known.holds(length - 1, _mixed((before + after)[row, at])):
            kept = letters[row[k]].tobytes()
            yield int(row[k]), kept[: at[k]] + kept[at[k] + 1 :]


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """``(word, n, near, near_n)``, both ways, for words one inserted, deleted or replaced letter apart.

    ``vocabulary`` is ``(word, n)``, each word once, of Latin-1 letters.
    """
    known = filters(vocabulary)
    sizes = {length: shard.words * length * (len(shard.letters) // 2 + 1) for length, shard in known.shards.items()}
    tasks = max(1, -(-sum(sizes.values()) // PROBES))
    shared = vocabulary.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_pylist()
            for part, letters in _letters(found):
                pairs = [(part[row], edit.decode("latin-1")) for row, edit in _edits(letters, shared.value)]
                at = pa.array([row for row, _ in pairs], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array([edit for _, edit in pairs], pa.string())], names=["word", "n", "near"]
                )

    passed = vocabulary.select("word", "n").repartition(tasks, "word").mapInArrow(run, "word string, n long, near string")
    found = passed.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")
    ways = F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return found.select(F.inline(ways))


def variants(vocabulary: DataFrame, share: int = 5) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each row of ``vocabulary (word, n)``.

    The form is the near word of largest ``n`` (ties: the smallest), if it has
    ``share`` times the word's; the root is where forms lead in the end, the word
    itself where it has none. Forms grow at least ``share``-fold, so the rounds that
    find roots, each doubling the way covered, are few. An empty vocabulary has no rows.
    """
    importable(vocabulary.sparkSession)
    vocabulary = stage(vocabulary.select("word", F.col("n").cast("long").alias("n")), "variants-words")
    best = near_pairs(vocabulary).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    chosen = (-F.col("best.less") >= share * F.col("n"))
    rows = stage(
        vocabulary.join(best, "word", "left").select(
            "word", F.when(chosen, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(chosen, -F.col("best.less")).alias("form_n"),
        ),
        "variants-forms",
    )
    links = stage(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stage(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variants-roots")
        moved = after.where("moved").limit(1).count()
        unstage(links)
        links = after.drop("moved")
        if not moved:
            break
    return rows.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The query's rows by plain equality joins on texts less one letter, crc32 by its table.
ORACLE = f"""
WITH RECURSIVE steps AS (
    SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS step),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '{RUN}')) AS run FROM documents),
lowered AS (SELECT id, translate(run, '{UPPER}', '{LOWER}') AS word FROM runs WHERE length(run) >= 6),
each AS (SELECT id, word, count(*) AS n FROM lowered GROUP BY ALL),
hashed AS (SELECT word, n, xor(4294967295, list_reduce(list_prepend(4294967295,
        list_transform(range(octet_length(encode(id || ':' || word))), lambda i: CAST('0x' || substr(hex(encode(id || ':' || word)), 2 * i + 1, 2) AS BIGINT))),
        lambda c, b: xor(step[1 + xor(c % 256, b)], c // 256))) AS h FROM each, steps),
typed AS (SELECT CASE WHEN h % 199 = 0 THEN substr(word, 1, CAST(h % length(word) AS INT)) || substr(word, CAST(h % length(word) AS INT) + 2) ELSE word END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (SELECT word, n, i, substr(word, 1, CAST(i AS INT)) || substr(word, CAST(i AS INT) + 2) AS short FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.short = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.short = b.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM pairs GROUP BY word),
formed AS (
    SELECT w.word, min(p.near) AS form, w.n, coalesce(any_value(b.n_near), 0) AS n_near, any_value(p.near_n) AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word LEFT JOIN pairs p ON p.word = w.word AND p.near_n = b.top AND p.near_n >= 5 * w.n
    GROUP BY w.word, w.n),
way AS (SELECT word, word AS root, 0 AS far FROM formed
    UNION ALL SELECT way.word, formed.form, far + 1 FROM way JOIN formed ON formed.word = way.root WHERE formed.form IS NOT NULL)
SELECT f.word, f.form, arg_max(w.root, w.far) AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN way w ON w.word = f.word GROUP BY f.word, f.form, f.n, f.n_near, f.form_n"""
