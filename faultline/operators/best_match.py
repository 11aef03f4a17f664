"""Best fuzzy match of long texts against a list of names by token-set score, without forming all pairs.

The score is the best of three comparisons around the shared tokens S: S against S with the name's other tokens, S against S
with the text's other tokens, and both sides with all their tokens.

The first two need a shared part of a certain share of one side's length. An index finds them: tokens go from rare to
frequent, and the frequent rest that is too short to reach that share is left out, so every pair that counts meets on
one of the tokens before it. All of this is joins and array functions. The third comparison can be high though no token
is shared, but only if both sides are of like length. Texts meet names of the length classes they can reach, in blocks of bounded size,
and a block compares only pairs whose letters allow a score that beats what the index has found.
The winner of all blocks and of the index is taken by an aggregate. The result is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.similarity import char_masks, lcs_with_masks, set_score, tokens
from faultline.session import stored

# Names and texts of a length class are dealt to blocks of about these sizes.
NAME_BLOCK = 2_000
TEXT_BLOCK = 5_000
_BINS = 64


def _length(words: Column) -> Column:
    """Length of the words joined by spaces."""
    return F.length(F.array_join(words, " "))


def _prefixes(sides: DataFrame, frequency: DataFrame, cutoff: float) -> DataFrame:
    """(id, token): of each side (id, words, size) the rarest tokens, up to where the others are too short to count.

    A comparison of S with S and the rest of this side reaches the cutoff only if S is at least ``size * (1 - q) / (1 + q)``
    long, with q = 1 - cutoff / 100. ``frequency`` (token, n) orders the tokens; tokens it does not have come first.
    """
    q = 1 - cutoff / 100
    least = F.col("size") * (1 - q) / (1 + q)
    each = sides.select("id", "size", F.explode("words").alias("token"))
    each = each.join(frequency.withColumnRenamed("token", "_token"), F.col("token") == F.col("_token"), "left")
    listed = each.groupBy("id", "size").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))).alias("order"))
    # what follows a token, joined by spaces
    after = F.aggregate(F.slice("order", F.col("at") + 1, F.size("order")), F.lit(-1), lambda s, x: s + F.length(x["token"]) + 1)
    placed = listed.select("id", "size", "order", F.explode(F.sequence(F.lit(1), F.size("order"))).alias("at"))
    # a token is left out if it and all after it are too short
    own = F.length(F.element_at("order", F.col("at"))["token"])
    from_here = F.when(F.col("at") == F.size("order"), own).otherwise(own + 1 + after)
    return placed.where(from_here >= F.floor(least * (1 - 1e-9))).select("id", F.element_at("order", F.col("at"))["token"].alias("token"))


def _by_index(texts: DataFrame, names: DataFrame, cutoff: float) -> DataFrame:
    """(id, name_id, score): pairs that reach the cutoff by their shared tokens alone."""
    frequency = names.select(F.explode("words").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    of_names = _prefixes(names, frequency, cutoff).toDF("name_id", "_token")
    of_texts = _prefixes(texts, frequency, cutoff)
    text_tokens = texts.select("id", F.explode("words").alias("token"))
    name_tokens = names.select(F.col("id").alias("name_id"), F.explode("words").alias("_token"))
    met = text_tokens.join(of_names, F.col("token") == F.col("_token")).select("id", "name_id")
    met = met.unionByName(of_texts.join(name_tokens, F.col("token") == F.col("_token")).select("id", "name_id")).distinct()
    left = texts.select("id", "words")
    right = names.select(F.col("id").alias("name_id"), F.col("words").alias("name_words"))
    pairs = met.join(left, "id").join(right, "name_id")
    shared = _length(F.array_intersect("words", "name_words"))
    rests = [_length(F.array_except("words", "name_words")), _length(F.array_except("name_words", "words"))]
    pairs = pairs.select("id", "name_id", shared.alias("s"), rests[0].alias("a"), rests[1].alias("b"))
    # a rest without tokens makes 100
    rest = F.least("a", "b")
    score = F.when(rest == 0, 100.0).otherwise(100.0 - 100.0 * (1 + rest) / (2 * F.col("s") + 1 + rest))
    return pairs.select("id", "name_id", score.alias("score")).where(F.col("score") >= cutoff)


def _letters(words: list[str]) -> np.ndarray:
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.bincount(codes % _BINS, minlength=_BINS).astype(np.int32)


def _compare_block(texts: pa.Table, names: pa.Table) -> pa.Table:
    """(id, name_id, score): for each text (id, words, floor) of a block its best names (id, words), ties included, by all their tokens."""
    lists, ids = names.column("words").to_pylist(), names.column("id").to_numpy()
    letters = np.stack([_letters(t) for t in lists]) if lists else np.zeros((0, _BINS), np.int32)
    count, chars = np.array([len(t) for t in lists], np.int64), letters.sum(axis=1, dtype=np.int64)
    by_token: dict[str, list[int]] = {}
    for i, words in enumerate(lists):
        for token in words:
            by_token.setdefault(token, []).append(i)
    found: list[tuple[int, int, float]] = []
    for key, words, floor in zip(*(texts.column(c).to_pylist() for c in ("id", "words", "floor")), strict=True):
        shared, shared_chars = np.zeros(len(lists), np.int64), np.zeros(len(lists), np.int64)
        for token in words:
            hits = by_token.get(token, [])
            shared[hits] += 1
            shared_chars[hits] += len(token)
        own = _letters(words)
        # Letters both rests can have in common: shared tokens take the same letters off both sides.
        common = np.minimum(letters, own).sum(axis=1, dtype=np.int64) - shared_chars
        n_a, n_b = len(words) - shared, count - shared
        only_a = own.sum() - shared_chars + np.maximum(n_a - 1, 0)
        only_b = chars - shared_chars + np.maximum(n_b - 1, 0)
        common = np.minimum(common + np.maximum(np.minimum(n_a, n_b) - 1, 0), np.minimum(only_a, only_b))
        joint = shared_chars + np.maximum(shared - 1, 0) + (shared > 0)
        bound = 100.0 - 100.0 * (only_a + only_b - 2 * common) / np.maximum(2 * joint + only_a + only_b, 1)
        # A hair of slack: bound and score are computed by the same formula on different integers.
        candidates = np.flatnonzero((bound >= floor - 1e-9) & (count > 0))
        best, chosen = floor, []
        for i in candidates[np.argsort(-bound[candidates], kind="stable")]:
            if bound[i] < best - 1e-9:
                break
            joint_words = set(words) & set(lists[i])
            rest_a = " ".join(t for t in words if t not in joint_words)
            rest_b = " ".join(t for t in lists[i] if t not in joint_words)
            both = len(" ".join(joint_words))
            value = set_score(both, len(rest_a), len(rest_b), lcs_with_masks(char_masks(rest_a), len(rest_a), rest_b)) if rest_a and rest_b else 100.0
            if value > best:
                best, chosen = value, []
            if value == best:
                chosen.append(int(ids[i]))
        found += [(key, i, best) for i in chosen]
    columns = list(zip(*found, strict=True)) or [[], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["id", "name_id", "score"])


def _by_length(texts: DataFrame, names: DataFrame, cutoff: float, name_block: int, text_block: int) -> DataFrame:
    """(id, name_id, score): the best name of each text (id, words, size, floor) within a block of names of like length.

    With all their tokens, both sides differ in length by a factor of at most (200 - cutoff) / cutoff. Classes of lengths
    step by that factor, so a text meets names of its own class and of those beside it.
    """
    step = float(np.log((200 - cutoff) / cutoff) + 1e-9)

    def class_of(size: Column) -> Column:
        return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / step).cast("int")

    def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
        sizes = rows.groupBy(F.col("class").alias("_class")).agg(F.ceil(F.count("*") / size).cast("int").alias(name))
        return F.broadcast(sizes)  # one row per class of lengths, a few dozen

    near = F.array(*[class_of(F.col("size")) + d for d in (-1, 0, 1)])
    left = stored(texts.select("id", "words", "floor", F.explode(near).alias("class")))
    right = stored(names.select("id", "words", class_of(F.col("size")).alias("class")))
    name_blocks, text_blocks = blocks(right, name_block, "nb"), blocks(left, text_block, "tb")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        met = rows.join(name_blocks, F.col("class") == F.col("_class")).drop("_class").join(text_blocks, F.col("class") == F.col("_class")).drop("_class")
        mine = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        met = met.withColumn("_" + own, mine).withColumn("_" + other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return met.drop("nb", "tb").groupBy("class", "_nb", "_tb")

    return dealt(left, "tb", "nb").cogroup(dealt(right, "nb", "tb")).applyInArrow(_compare_block, "id long, name_id long, score double")


def best_match(
    texts: DataFrame, text: str, names: DataFrame, *, name: str, code: str, place: str, cutoff: float,
    name_block: int = NAME_BLOCK, text_block: int = TEXT_BLOCK,
) -> DataFrame:
    """Per distinct text the best name by token-set score at or above ``cutoff``.

    ``names`` holds one row per name with its code; of equal scores the name first by (place, name) wins.
    Returns (text, match_name, match_code, match_score), with nulls for unmatched texts.
    """
    numbered = stored(names.select(name, code, place).withColumn("id", F.monotonically_increasing_id()))
    words = F.array_sort(F.array_distinct(tokens(F.col(name))))
    listed = numbered.select("id", words.alias("words"), F.struct(place, name).alias("order"))
    listed = stored(listed.withColumn("size", _length(F.col("words"))).where("size > 0"))
    own = F.array_sort(F.array_distinct(tokens(F.col(text))))
    asked = stored(texts.select(F.col(text)).withColumn("id", F.monotonically_increasing_id()).withColumn("words", own))
    filled = asked.select("id", "words", _length(F.col("words")).alias("size")).where("size > 0")
    indexed = stored(_by_index(filled, listed, cutoff))
    tops = indexed.groupBy(F.col("id").alias("_id")).agg(F.max("score").alias("top"))
    # nothing beats 100, and by all tokens only equal sets reach it, which the index has as well
    rest = filled.join(tops, F.col("id") == F.col("_id"), "left").where("top IS NULL OR top < 100")
    rest = rest.select("id", "words", "size", F.coalesce("top", F.lit(float(cutoff))).alias("floor"))
    blocks = _by_length(rest, listed, cutoff, name_block, text_block)
    every = indexed.unionByName(blocks).join(listed.select(F.col("id").alias("name_id"), "order"), "name_id")
    first = F.max("score").alias("score")
    best = every.groupBy("id").agg(first, F.min_by(F.col("name_id"), F.struct(-F.col("score"), F.col("order"))).alias("name_id"))
    labels = numbered.select(F.col("id").alias("name_id"), F.col(name).alias("match_name"), F.col(code).alias("match_code"))
    chosen = best.join(labels, "name_id").select(F.col("id").alias("_id"), "match_name", "match_code", F.col("score").alias("match_score"))
    return asked.join(chosen, F.col("id") == F.col("_id"), "left").select(text, "match_name", "match_code", "match_score")
