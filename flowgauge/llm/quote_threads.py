"""Conversations ordered by reply and without quotes: which message answers which is read off the passages it quotes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.tables import stored, with_place

#: What stands before a quoted line: a mark per level, with blanks between.
MARKS = r"^[ \t]*(?:>[ \t]*)+"
#: Where a normalised text is cut into sentences.
SENTENCE_END = r"(?<=[.!?…]) |(?<=[。！？])"
#: Words of the runs by which an excerpt that is no sentence is found.
RUN_WORDS = 5


def normalised(text: Column) -> Column:
    """A passage as it is compared: A-Z as a-z, runs of blanks as one space, none at the ends."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(low, r"[\x20\x09-\x0D]+", " "))


def _lines(text: Column) -> Column:
    """Array of (level, body) of all lines: how many marks stand before a line, and the line without them."""
    return F.transform(
        F.split(text, "\n"),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), r"[^>]", "")).alias("level"),
            F.regexp_replace(line, MARKS, "").alias("body"),
        ),
    )


def _runs(lines: Column) -> Column:
    """Array of (level, body) of passages: neighbouring lines of one level joined, cut at blank lines.

    The lines at which a passage starts are found first, then each passage is a slice: linear in the lines.
    """

    def starts(all_: Column) -> Column:
        def begins(i: Column) -> Column:
            now, last = F.get(all_, i), F.get(all_, i - 1)
            return (i == 0) | (now["level"] != last["level"]) | (F.trim(now["body"]) == "") | (F.trim(last["body"]) == "")

        return F.filter(F.sequence(F.lit(0), F.size(all_) - 1), begins)

    def cut(both: Column) -> Column:
        def passage(start: Column, nth: Column) -> Column:
            end = F.coalesce(F.get(both["starts"], nth + 1), F.size(both["lines"]))
            body = F.array_join(F.slice(both["lines"], start + 1, end - start).getField("body"), "\n")
            return F.struct(F.get(both["lines"], start)["level"].alias("level"), body.alias("body"))

        return F.transform(both["starts"], passage)

    # Lines and starts are elements of arrays, so that they are computed once and not once a line.
    with_starts = F.transform(F.array(lines), lambda x: F.struct(x.alias("lines"), starts(x).alias("starts")))
    some = F.filter(with_starts, lambda x: F.size(x["lines"]) > 0)
    return F.flatten(F.transform(some, cut))


def _passages(lines: Column, runs: Column, whole: Column | None = None) -> Column:
    """Distinct (level, key, words) of passages: runs of lines and single lines (and the whole)."""
    parts = F.concat(lines, runs) if whole is None else F.concat(lines, runs, F.array(F.struct(F.lit(0).alias("level"), whole.alias("body"))))
    keyed = F.transform(parts, lambda p: F.struct(p["level"].alias("level"), normalised(p["body"]).alias("text")))
    keyed = F.filter(keyed, lambda p: p["text"] != "")
    return F.array_distinct(
        F.transform(keyed, lambda p: F.struct(p["level"], F.md5(p["text"].cast("binary")).alias("key"), F.size(F.split(p["text"], " ")).alias("words")))
    )


def _pieces(parts: Column, whole: Column) -> Column:
    """(kind, key, words) of the sentences of normalised ``parts``, and of all runs of RUN_WORDS words of ``whole``.

    A run counts as one word: n neighbouring words make n - RUN_WORDS + 1 runs.
    """
    sentences = F.flatten(F.transform(parts, lambda p: F.split(p, SENTENCE_END)))
    sentences = F.array_distinct(F.filter(F.transform(sentences, lambda x: F.trim(x)), lambda x: x != ""))

    def piece(kind: str, text: Column, size: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.xxhash64(F.lit(kind), text).alias("key"), size.alias("words"))

    def runs(words: Column) -> Column:
        last = F.size(words) - RUN_WORDS
        places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: piece("run", F.concat_ws(" ", *[F.get(words, i + k) for k in range(RUN_WORDS)]), F.lit(1)))

    # The words are an element of an array so that they are split once, not once a run.
    all_runs = F.flatten(F.transform(F.array(F.split(whole, " ")), runs))
    return F.concat(F.transform(sentences, lambda x: piece("sentence", x, F.size(F.split(x, " ")))), all_runs)


def _excerpt_hits(known: DataFrame) -> DataFrame:
    """conv_id, turn, level, held, kind, words: sentences and runs of words that quotes share with earlier messages' own words.

    As with whole passages, a piece has one holder, the earliest, by a minimum that is combined before the shuffle. Only
    messages of conversations with quotes are cut up.
    """
    quoting = known.where("size(excerpts) > 0")
    level = F.explode("excerpts").alias("e")
    asked = quoting.select("conv_id", "turn", level).select("conv_id", "turn", "e.level", F.explode(_pieces(F.col("e.parts"), F.col("e.text"))).alias("p"))
    asked = asked.select("conv_id", "turn", "level", "p.*").distinct()
    body = F.coalesce("body", F.lit(""))
    parts = F.transform(F.concat(F.split(body, "\n"), F.split(body, r"\n[ \t]*\n")), normalised)
    own = known.join(quoting.select("conv_id").distinct(), "conv_id", "left_semi")
    own = own.select("conv_id", "turn", F.explode(_pieces(parts, normalised(body))).alias("p")).select("conv_id", "turn", "p.key")
    first = own.join(asked.select("conv_id", "key").distinct(), ["conv_id", "key"], "left_semi")
    first = first.groupBy("conv_id", "key").agg(F.min("turn").alias("held"))
    hits = asked.join(first, ["conv_id", "key"]).where("held < turn").groupBy("conv_id", "turn", "level", "held", "kind")
    hits = hits.agg(F.sum("words").alias("words"))
    more = F.when(F.col("kind") == "run", F.lit(RUN_WORDS - 1)).otherwise(F.lit(0))
    return hits.select("conv_id", "turn", "level", "held", "kind", (F.col("words") + more).alias("words"))


def quote_threads(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, body, n_quotes, quote_depth, parent_turn, thread_turn, depth, place of every message.

    * A line's quote level is the number of ``>`` marks before it. ``body`` is what stands at level 0, without blank
      lines at its ends; ``n_quotes`` counts the quoted passages (neighbouring lines of one level), ``quote_depth`` is the
      highest level.
    * A quoted passage or line belongs to the earliest message of the conversation whose own words hold it as a whole, a
      passage or a line, compared by a hash of the normalised text; so does a sentence of it, or a run of RUN_WORDS words,
      to the earliest that holds those. The words that a message quotes of another are the most that whole passages,
      sentences or runs show. An excerpt under RUN_WORDS words that is no sentence is not found. ``parent_turn`` is the earlier message that the lowest
      quote level with any match quotes most words of (of equals, the later); null without one.
    * ``thread_turn`` is the first message of the reply chain, ``depth`` its length, and ``place`` numbers a conversation's
      messages from 0, thread by thread in the order of turns: every reply comes after what it answers.
    * A null text has a null body and quotes nothing; an empty one an empty body. Rows with a null conv_id or turn answer
      nothing and are answered by none. Rows that repeat (conv_id, turn) are messages of one node: they share their
      parent. Other columns are not read.

    Each passage of a conversation has one original, found by a minimum that is combined before the shuffle, so a line
    that thousands of messages hold or quote makes one row and no pairs. Reply chains are followed by doubling.
    """
    read = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.col("text").cast("string").alias("text"))
    split = read.withColumn("lines", _lines(F.coalesce("text", F.lit(""))))
    own = F.filter("lines", lambda x: x["level"] == 0)
    body = F.regexp_replace(F.array_join(F.transform(own, lambda x: x["body"]), "\n"), r"^(?:[ \t]*\n)+|(?:\n[ \t]*)+$", "")
    lines = F.when(F.exists("lines", lambda x: x["level"] > 0), F.col("lines"))
    parsed = split.select(
        "conv_id", "turn", "role", F.when(F.col("text").isNotNull(), body).alias("body"),
        F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0)).cast("long").alias("quote_depth"), lines.alias("lines"),
    )
    # Only messages with quotes are cut into passages here.
    runs = F.filter(_runs(F.coalesce("lines", F.array().cast("array<struct<level:int,body:string>>"))), lambda p: (p["level"] > 0) & (F.trim(p["body"]) != ""))
    parsed = parsed.withColumn("quote_runs", runs)
    quoted = F.filter(F.coalesce("lines", F.array().cast("array<struct<level:int,body:string>>")), lambda x: x["level"] > 0)
    parsed = parsed.select(
        "conv_id", "turn", "role", "body", F.size("quote_runs").cast("long").alias("n_quotes"), "quote_depth",
        _passages(quoted, F.col("quote_runs")).alias("quotes"),
        F.transform(
            "quote_runs",
            lambda p: F.struct(
                p["level"].alias("level"), normalised(p["body"]).alias("text"),
                F.transform(F.concat(F.split(p["body"], "\n"), F.array(p["body"])), normalised).alias("parts"),
            ),
        ).alias("excerpts"),
    )
    parsed = stored(parsed.withColumn("row", F.monotonically_increasing_id()), "messages")
    known = parsed.where("conv_id is not null and turn is not null")
    # Own words are keyed in conversations with quotes alone: elsewhere nothing asks for them.
    quoting = known.where("size(quotes) > 0").select("conv_id").distinct()
    own_lines = F.transform(F.split(F.coalesce("body", F.lit("")), "\n"), lambda x: F.struct(F.lit(0).alias("level"), x.alias("body")))
    originals = known.join(quoting, "conv_id", "left_semi").withColumn("own", own_lines)
    originals = originals.withColumn("originals", _passages(F.col("own"), _runs(F.col("own")), F.coalesce("body", F.lit(""))))
    asked = known.where("size(quotes) > 0").select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.*")
    asked = asked.distinct()
    holders = originals.select("conv_id", "turn", F.explode("originals.key").alias("key"))
    wanted = asked.select("conv_id", "key").distinct()
    first = holders.join(wanted, ["conv_id", "key"], "left_semi").groupBy("conv_id", "key").agg(F.min("turn").alias("held"))
    hits = asked.join(first, ["conv_id", "key"]).where("held < turn")
    hits = hits.groupBy("conv_id", "turn", "level", "held").agg(F.sum("words").alias("words")).withColumn("kind", F.lit("whole"))
    hits = hits.unionByName(_excerpt_hits(known))
    hits = hits.groupBy("conv_id", "turn", "level", "held").agg(F.max("words").alias("words"))
    best = F.min_by("held", F.struct("level", (-F.col("words")).alias("w"), (-F.col("held")).alias("h")))
    parents = stored(hits.groupBy("conv_id", "turn").agg(best.alias("parent")), "parents")
    chains = _chains(parents)
    linked = parents.join(chains, ["conv_id", "turn"]).select(
        F.col("conv_id").alias("c"), F.col("turn").alias("t"), "parent", "root", "depth"
    )
    # Only what orders messages goes through the ranges; bodies meet their places once, at the end.
    narrow = parsed.select("row", "conv_id", "turn", "role", F.xxhash64("body").alias("hash"))
    narrow = narrow.join(linked, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
    narrow = narrow.select(
        "row", "conv_id", "turn", "role", "hash", F.col("parent").alias("parent_turn"),
        F.coalesce("root", "turn").alias("thread_turn"), F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
    )
    placed = with_place(narrow, ["conv_id"], [F.col("thread_turn"), F.col("turn"), F.col("role"), F.col("hash"), F.col("row")], "place")
    placed = placed.select("row", "parent_turn", "thread_turn", "depth", "place")
    out = parsed.select("row", "conv_id", "turn", "role", "body", "n_quotes", "quote_depth").join(placed, "row")
    return out.drop("row")


def _chains(parents: DataFrame) -> DataFrame:
    """conv_id, turn, root, depth of every message that has a parent: each round doubles the steps followed."""
    now = parents.select("conv_id", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth"))
    while True:
        up = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        joined = now.join(up, ["conv_id", "root"], "left")
        after = joined.select(
            "conv_id", "turn", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("next").isNotNull().alias("moved"),
        )
        after = stored(after, "chains")
        if after.where("moved").isEmpty():
            return after.drop("moved")
        now = after.drop("moved")


def chat_text(threads: DataFrame) -> DataFrame:
    """conv_id, place, role, message: each message as a line-framed chat turn, with its quotes gone."""
    role = F.coalesce("role", F.lit("unknown"))
    return threads.select("conv_id", "place", "role", F.concat(F.lit("<|"), role, F.lit("|>\n"), F.coalesce("body", F.lit("")), F.lit("\n")).alias("message"))
