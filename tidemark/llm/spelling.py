"""Spelling variants: words one edit apart, found by Gram matrices of their letter counts.

A word is a vector of letter counts. One inserted or deleted letter moves it by a squared
distance of 1, one replaced letter by 2, so only such pairs of equal or adjacent lengths can be
one edit apart. Words are dealt into blocks by length and by how many of their letters are of
some few kinds: an edit changes such a sum by at most one, so each block has few neighbours.
Squared distances of two blocks come from one matrix product; what is near is then compared
letter by letter. Large blocks are cut into tiles of bounded size.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.session import splittable

Edit = Callable[[Iterable[str], str], dict[str, str]]

#: Least letters and occurrences of a word, and how much more common a form has to be.
LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
#: Words of a tile at most, about; rows of a Gram matrix at a time; entries a task counts before it passes them on.
TILE, STRIP, MOST_COUNTED = 2048, 256, 200_000
#: Words of all pairs of tiles that a task compares one after the other, about.
TASK_WORDS = 1 << 15
# The letters, a to z and those from U+00C0 to U+00FF.
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(map(chr, range(0xC0, 0x100)))
#: Kinds of letters whose numbers a block's words have in common; no letter is of two kinds.
KINDS = ("aou", "nrm", "tdl")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def misspelled(words: Iterable[str], doc_id: str) -> dict[str, str]:
    """One of 199 words, by the crc32 of ``doc_id:word``, and the same word without one letter."""
    begin, found = zlib.crc32(f"{doc_id}:".encode()), {}
    for word in words:
        h = zlib.crc32(word.encode(), begin)
        if not h % 199:
            k = h % len(word)
            found[word] = word[:k] + word[k + 1 :]
    return found


def count_words(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS, edit: Edit | None = None
) -> DataFrame:
    """``(word, n)`` of all words of ``least_letters`` or more.

    ``edit`` is given the distinct words of a text and the text's id (empty for a null one), and
    returns those to be changed with what they become; words get shorter by it, if anything. Every
    task adds up before it passes counts on.
    """
    run = f"[a-z\u00c0-\u00ff]{{{least_letters},}}"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, total = re.compile(run).findall, Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                words = find(str((text.as_py() or b"").translate(_LOWER), "utf-8", "replace"))
                changed = edit(set(words), doc_id or "") if edit else {}
                if changed:
                    words = [changed.get(word, word) for word in words]
                    words = [word for word in words if len(word) >= least_letters]
                total.update(words)
                if len(total) > MOST_COUNTED:
                    yield passed_on(total)
                    total.clear()
        yield passed_on(total)

    def passed_on(total: Counter[str]) -> pa.RecordBatch:
        words = pa.array(list(total), pa.string())
        return pa.record_batch([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(id_col).cast("string"), text_col).mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _block_key(word: Column) -> Column:
    sums = [F.length(word) - F.length(F.translate(word, kind, "")) for kind in KINDS]
    return F.array(F.length(word), *sums)


def _later_neighbours() -> list[list[int]]:
    """What an edit adds to a block's length and sums, of each two opposite steps one."""
    kinds = range(len(KINDS))
    unit = [[0] * len(KINDS)] + [[int(k == j) for k in kinds] for j in kinds]
    longer = [[1, *one] for one in unit]
    replaced = {tuple(a - b for a, b in zip(one, two)) for one in unit for two in unit}
    return longer + [[0, *step] for step in sorted(replaced) if step > (0,) * len(KINDS)]


def tiles(words: DataFrame) -> DataFrame:
    """``(task, one, two, side, word, n)``: the words of each pair of tiles that may hold words one edit apart.

    A block of more words than a tile is dealt into tiles by hash, and each of them meets all
    tiles of the block itself and of its neighbours. Pairs of tiles are dealt into tasks.
    """
    placed = stored(words.select("word", "n", _block_key(F.col("word")).alias("block")), "words")
    sizes = placed.groupBy("block").agg(F.count("*").alias("size"))
    sizes = stored(sizes.select("block", "size", F.ceil(F.col("size") / TILE).cast("int").alias("parts")), "blocks")
    steps = F.array(*[F.array(*map(F.lit, step)) for step in _later_neighbours()])
    ahead = sizes.select("block", "parts", F.explode(steps).alias("step"))
    ahead = ahead.select("block", "parts", F.zip_with("block", "step", lambda a, b: a + b).alias("other"))
    other = sizes.select(F.col("block").alias("other"), F.col("parts").alias("other_parts"))
    pairs = ahead.join(splittable(other), "other").select("block", "other", "parts", "other_parts")
    pairs = pairs.unionByName(sizes.select("block", F.col("block").alias("other"), "parts", F.col("parts").alias("other_parts")))
    pairs = stored(pairs, "pairs")
    # A word goes to the tasks of its own tile with every tile of the other block.
    whole = pairs.join(sizes.select("block", "size"), "block").agg(F.sum(F.col("size") * F.col("other_parts"))).first()[0]
    tasks = 1 + 2 * (whole or 0) // TASK_WORDS
    first = pairs.select("block", "parts", F.lit(0).alias("side"), "other", F.col("other_parts").alias("across"))
    second = pairs.where("block <> other").select(
        F.col("other").alias("block"), F.col("other_parts").alias("parts"), F.lit(1).alias("side"),
        F.col("block").alias("other"), F.col("parts").alias("across"),
    )
    sent = placed.join(splittable(first.unionByName(second)), "block")
    sent = sent.withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("across") - 1)))
    home, away = F.struct("block", F.col("own").alias("part")), F.struct(F.col("other").alias("block"), "part")
    same = F.col("block") == F.col("other")
    # Within a block a pair of tiles is the same task from both, with the lower one as its first side.
    one = F.when(same, F.least(home, away)).when(F.col("side") == 0, home).otherwise(away)
    two = F.when(same, F.greatest(home, away)).when(F.col("side") == 0, away).otherwise(home)
    side = F.when(same, (F.col("own") > F.col("part")).cast("int")).otherwise(F.col("side"))
    sent = sent.select(one.alias("one"), two.alias("two"), side.alias("side"), "word", "n")
    task = F.pmod(F.xxhash64("one.block", "one.part", "two.block", "two.part"), F.lit(tasks))
    return sent.select(task.alias("task"), F.xxhash64("one.block", "one.part").alias("one"), F.xxhash64("two.block", "two.part").alias("two"), "side", "word", "n")


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, row by row and filled with zeros, and lengths."""
    lengths = np.array([len(word) for word in words])
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    rows = np.zeros((len(words), int(lengths.max(initial=0)) + 1), np.uint32)
    rows[np.arange(rows.shape[1]) < lengths[:, None]] = points
    return rows, lengths


def _counts(words: list[str]) -> np.ndarray:
    """Letter counts row by row; anything else has a column of its own."""
    column = np.full(257, len(LETTERS))
    column[[ord(letter) for letter in LETTERS]] = np.arange(len(LETTERS))
    points = np.minimum(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), 256)
    owners = np.repeat(np.arange(len(words)), [len(word) for word in words])
    size = len(LETTERS) + 1
    return np.bincount(owners * size + column[points], minlength=len(words) * size).reshape(-1, size).astype(np.float64)


def one_edit(one: np.ndarray, one_sizes: np.ndarray, two: np.ndarray, two_sizes: np.ndarray) -> np.ndarray:
    """Whether row by row two words differ by one inserted, deleted or replaced letter."""
    width = max(one.shape[1], two.shape[1])
    one, two = (np.pad(a, ((0, 0), (0, width - a.shape[1]))) for a in (one, two))
    swap = (one_sizes > two_sizes)[:, None]
    short, long = np.where(swap, two, one), np.where(swap, one, two)
    least, most = np.minimum(one_sizes, two_sizes), np.maximum(one_sizes, two_sizes)
    differs = short != long
    replaced = (least == most) & (differs.sum(axis=1) == 1)
    # After the first difference the longer word goes on one letter later.
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    shifted = (short[:, :-1] != long[:, 1:]) & (np.arange(width - 1) >= first[:, None]) & (np.arange(width - 1) < least[:, None])
    return replaced | ((most == least + 1) & ~shifted.any(axis=1))


def near_pairs(one: list[str], two: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of words one edit apart, of two lists or of one list with itself, each pair once."""
    a = _counts(one)
    b = a if two is None else _counts(two)
    letters = _letters(one)
    others = letters if two is None else _letters(two)
    b_squares, found = (b * b).sum(axis=1), []
    for begin in range(0, len(one), STRIP):
        part = a[begin : begin + STRIP]
        squares = (part * part).sum(axis=1)[:, None] + b_squares - 2 * (part @ b.T)
        # Letters beyond those known share a column, so one may replace another without any distance.
        i, j = np.nonzero((squares <= 2) & ((squares > 0) | (part[:, -1:] > 0)))
        i += begin
        if two is None:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 1 << 14):
            x, y = i[k : k + (1 << 14)], j[k : k + (1 << 14)]
            near = one_edit(letters[0][x], letters[1][x], others[0][y], others[1][y])
            found.append((x[near], y[near]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _task_links(rows: pa.Table) -> pa.Table:
    """Of each pair of tiles and word: its number of near words and the best of them, the most common, then the first."""
    rows = rows.sort_by([(name, "ascending") for name in ("one", "two", "side", "word")])
    words, n, side = rows["word"].to_pylist(), rows["n"].to_numpy(), rows["side"].to_numpy()
    one, two = rows["one"].to_numpy(), rows["two"].to_numpy()
    heads = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
    found = []
    for begin, end in zip(heads.tolist(), [*heads[1:].tolist(), len(words)]):
        cut = begin + int(np.searchsorted(side[begin:end], 1))
        if one[begin] == two[begin]:
            i, j = near_pairs(words[begin:end])
            found.append((i + begin, j + begin))
        elif begin < cut < end:
            i, j = near_pairs(words[begin:cut], words[cut:end])
            found.append((i + begin, j + cut))
    i, j = (np.concatenate([pair[k] for pair in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
    i, j = np.concatenate([i, j]), np.concatenate([j, i])
    # A word stands in one row per pair of tiles; of equally common near words the first is the one least by its bytes.
    names = np.empty(len(words), np.int64)
    names[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((names[j], -n[j], i))
    i, j = i[order], j[order]
    heads = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else i
    best = j[heads]
    return pa.table({
        "word": pa.array([words[k] for k in i[heads]], pa.string()),
        "n_near": pa.array(np.diff(np.append(heads, len(i))), pa.int64()),
        "near": pa.array([words[k] for k in best], pa.string()),
        "near_n": pa.array(n[best], pa.int64()),
    })


def group_variants(counts: DataFrame, *, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per word of ``least_count`` or more occurrences.

    ``counts`` has ``(word, n)``, each word once. Words are near if one inserted, deleted or
    replaced code point makes one the other. The form of a word is its most common near
    word (of equally common ones the first by code points) if that has at least ``times``
    its occurrences, else null; the root is the last of the forms of forms, or the word itself.
    Null words are left out. As every form is ``times`` as common, chains are short.
    """
    words = stored(counts.where((F.col("n") >= least_count) & F.col("word").isNotNull()).select("word", "n"), "counts")
    links = tiles(words).groupBy("task").applyInArrow(_task_links, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    links = links.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    known = F.when(-F.col("best.less") >= times * F.col("n"), F.col("best"))
    formed = words.join(links, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), known["near"].alias("form"), (-known["less"]).alias("form_n")
    )
    formed = stored(formed, "forms")
    roots = _followed(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _followed(steps: DataFrame) -> DataFrame:
    """``(word, root)``: each word's last one; a round doubles the steps taken."""
    open_ends = True
    while open_ends:
        after = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = steps.join(splittable(after), "root", "left")
        steps = stored(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        open_ends = bool(steps.where("moved").take(1))
        steps = steps.drop("moved")
    return steps


def spelling_variants(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS, edit: Edit | None = None, **options
) -> DataFrame:
    """``group_variants`` of the words of whole texts.

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, of at least
    ``least_letters``, with A-Z in lower case; ``edit`` is as in ``count_words``. Null and empty texts have none; null ids and
    repeated rows count like any others. An empty table gives no rows.
    """
    return group_variants(count_words(docs, id_col=id_col, text_col=text_col, least_letters=least_letters, edit=edit), **options)
