"""Chat formatting by quotation linking (operator 7).  DataFrame functions only.

A message's lines are parsed for nested quote marks (``>``, with or without blanks between them).
Lines of level 0 are the message's own words; "... wrote:" lines that introduce a quote go too.
Neighbouring lines of one level form a passage; lines without a word don't part it.  Passages are
normalised (letters and digits only, lower case), so a quote that was wrapped anew reads alike, and
hashed: every window of ``WORDS`` words, or the whole if it is shorter.  An original also offers each
of its shorter lines.  A quoted hash comes from an earlier message of the same conversation (the
earliest turn), else, from ``FAR_WORDS`` words on, from the least (conversation, turn) of another
one.  Hashes are reduced to those minima before any join.  A passage is linked with the message that
most of its hashes come from, if that is a third of them or more; ties go to the own conversation,
then to the least.  A message replies to the message that most hashes of its linked passages of the
outermost level come from; without such a link to its own conversation it replies to the turn before
it.  ``thread`` and ``depth`` place each message in the tree of replies by doubling pointers, so
(conv_id, thread, depth, turn) puts every reply behind what it replies to.

Null text counts as empty; rows with a null conv_id or turn link with nothing and stay; repeated
rows stay, each with the same links; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import table, written

MARKS = r"^[ \t]*(>[> \t]*)"
INTRO = r"(wrote|schrieb|escribió|a écrit) ?:[ \t]*$"
WORDS = 4  # words that are hashed together
FAR_WORDS = 3  # words that may be linked with another conversation; shorter passages are said everywhere
LINK_SHARE = 3  # one in so many of a passage's hashes must come from the original


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\r?\n")


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[ \t]", ""))


def normal(line: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(line, r"[^\p{L}\p{N}]+", " ")))


def _intro(line: Column, after: Column) -> Column:
    """Whether a line introduces the quote that follows it."""
    return (_level(line) == 0) & line.rlike(INTRO) & F.coalesce(_level(after) > 0, F.lit(False))


def message_passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, t64, at, level, key, size) of every hash of every passage; ``at`` counts a message's passages.

    ``size`` is the number of words hashed.  Short lines of own passages come with a null ``at``."""
    rows = messages.select("conv_id", "turn", F.xxhash64("text").alias("t64"), _lines(F.col("text")).alias("ls"))
    line = lambda x, i: F.struct(_level(x).alias("level"), F.when(_intro(x, F.get("ls", i + 1)), F.lit("")).otherwise(normal(F.regexp_replace(x, MARKS, ""))).alias("words"))
    rows = rows.withColumn("ls", F.filter(F.transform("ls", line), lambda z: z["words"] != "")).where(F.size("ls") > 0)
    first = F.filter(F.sequence(F.lit(0), F.size("ls") - 1), lambda i: (i == 0) | (F.get("ls", i)["level"] != F.get("ls", i - 1)["level"]))
    rows = rows.withColumn("first", first)
    own = lambda x, k: F.slice("ls", x + 1, F.coalesce(F.get("first", k + 1), F.size("ls")) - x)
    joined = F.transform("first", lambda x, k: F.struct(F.get("ls", x)["level"].alias("level"), F.array_join(F.transform(own(x, k), lambda z: z["words"]), " ").alias("words")))
    whole = rows.select("conv_id", "turn", "t64", F.posexplode(joined).alias("at", "p")).select("conv_id", "turn", "t64", "at", "p.level", F.split("p.words", " ").alias("ws"))
    whole = whole.withColumn("th", F.transform("ws", lambda x: F.xxhash64(x))).withColumn("size", F.least(F.size("ws"), F.lit(WORDS)))
    keys = F.transform(F.sequence(F.lit(1), F.size("th") - F.col("size") + 1), lambda i: F.xxhash64(F.slice("th", i, F.col("size"))))
    whole = whole.select("conv_id", "turn", "t64", "at", "level", F.explode(keys).alias("key"), "size")
    short = rows.select("conv_id", "turn", "t64", F.explode("ls").alias("z")).where("z.level = 0").select("conv_id", "turn", "t64", F.split("z.words", " ").alias("ws"))
    short = short.where(F.size("ws") < WORDS).select("conv_id", "turn", "t64", F.lit(None).cast("int").alias("at"), F.lit(0).alias("level"),
                                                     F.xxhash64(F.transform("ws", lambda x: F.xxhash64(x))).alias("key"), F.size("ws").alias("size"))
    return whole.unionByName(short)


def own_text(text: Column) -> Column:
    """The lines of level 0, less the lines that introduce a quote."""
    lines = _lines(text)
    kept = F.filter(lines, lambda x, i: (_level(x) == 0) & ~(x.rlike(INTRO) & F.coalesce(_level(F.get(lines, i + 1)) > 0, F.lit(False))))
    return F.regexp_replace(F.array_join(kept, "\n"), "^[ \t\r\n]+|[ \t\r\n]+$", "")


def _votes(passages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, orig, votes) of every quoted passage; ``orig`` is null without a link."""
    own, quoted = passages.where("level = 0"), passages.where("level > 0")
    asked = own.join(quoted.select("key").distinct(), "key", "left_semi")
    # written, so that the joins below can split a hot hash of the quotes
    here = written(asked.groupBy("conv_id", "key", "size").agg(F.min("turn").alias("turn")), "quote_originals")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("conv_id"))  # two rows a hash leave each task
    two = here.where(F.col("size") >= FAR_WORDS).select("key", "conv_id", "turn").withColumn("r", rank).where("r <= 2")
    one = F.struct("conv_id", "turn")
    far = written(two.groupBy("key").agg(F.min(one).alias("a"), F.max(one).alias("b")), "quote_far_originals")
    q = quoted.join(here.select("conv_id", "key", F.col("turn").alias("here")), ["conv_id", "key"], "left").join(far, "key", "left")
    away = F.when(F.col("a.conv_id") != F.col("conv_id"), F.col("a")).when(F.col("b.conv_id") != F.col("conv_id"), F.col("b"))
    orig = F.when(F.col("here") < F.col("turn"), F.struct("conv_id", F.col("here").alias("turn"))).otherwise(away)
    by = ["conv_id", "turn", "t64", "at", "level"]
    n = q.withColumn("orig", orig).groupBy(*by, "orig").agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by(F.struct("orig", "n"), F.when(F.col("orig").isNotNull(), F.struct(F.col("n"), F.col("orig.conv_id") == F.col("conv_id"), -F.col("orig.conv_id"), -F.col("orig.turn"))))
    got = n.groupBy(*by).agg(F.sum("n").alias("every"), best.alias("best"))
    is_link = F.col("best.n") * LINK_SHARE >= F.col("every")
    return got.select("conv_id", "turn", "level", F.when(is_link, F.col("best.orig")).alias("orig"), F.col("best.n").alias("votes"))


def reply_tree(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth) by (conv_id, turn, reply_to): the message a tree starts with, and the replies above.

    Each round doubles the length of the pointers: as many rounds as the depth has binary digits."""
    at = replies.select("conv_id", "turn", F.coalesce("reply_to", "turn").alias("up"), F.col("reply_to").isNotNull().cast("long").alias("depth"))
    at, before = written(at, "reply_tree"), 0
    while (deep := at.agg(F.sum("depth")).first()[0] or 0) > before:
        before = deep
        up = at.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("higher"), F.col("depth").alias("more"))
        at = written(at.join(up, ["conv_id", "up"]).select("conv_id", "turn", F.col("higher").alias("up"), (F.col("depth") + F.col("more")).alias("depth")), "reply_tree")
    return at.select("conv_id", "turn", F.col("up").alias("thread"), "depth")


def linked(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, own_text, levels, n_quoted, n_linked, reply_to, from_conv, from_turn, thread, depth) of every message.

    ``levels``: deepest quote level; ``n_quoted``, ``n_linked``: quoted passages and those with a link; ``reply_to``: turn
    in the own conversation; ``from_*``: the original of most of the outermost quotes wherever it stands; ``thread``: the
    turn that the message's tree of replies starts with; ``depth``: replies between the two."""
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    placed = rows.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    passages = written(message_passages(placed.dropDuplicates(["conv_id", "turn", "text"])), "message_passages")
    q = written(_votes(passages), "quote_votes")
    top = q.groupBy("conv_id", "turn").agg(F.max("level").alias("levels"), F.count(F.lit(1)).alias("n_quoted"), F.count("orig").alias("n_linked"))
    votes = q.where((F.col("level") == 1) & F.col("orig").isNotNull()).groupBy("conv_id", "turn", "orig").agg(F.sum("votes").alias("n"))
    vote = votes.groupBy("conv_id", "turn").agg(F.max_by("orig", F.struct(F.col("n"), -F.col("orig.conv_id"), -F.col("orig.turn"))).alias("orig"))
    last = placed.select("conv_id", "turn").distinct()
    before = last.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("before"))
    reply = F.coalesce(F.when(F.col("orig.conv_id") == F.col("conv_id"), F.col("orig.turn")), F.col("before"))
    at = written(last.join(top, ["conv_id", "turn"], "left").join(vote, ["conv_id", "turn"], "left").join(before, ["conv_id", "turn"], "left").withColumn("reply_to", reply), "message_replies")
    got = rows.join(at, ["conv_id", "turn"], "left").join(reply_tree(at), ["conv_id", "turn"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return got.select("conv_id", "turn", "role", own_text(F.col("text")).alias("own_text"), zero("levels"), zero("n_quoted"), zero("n_linked"),
                      "reply_to", F.col("orig.conv_id").alias("from_conv"), F.col("orig.turn").alias("from_turn"), "thread", "depth")


def op7_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over all conversations: messages without quotes; (conv_id, thread, depth, turn) is the reply order."""
    return linked(table(spark, sf_dir, "conversations"))


_L = r"""length(regexp_replace(regexp_extract({0}, '^[ \t]*(>[> \t]*)', 1), '[ \t]', '', 'g'))"""
_INTRO = "'(wrote|schrieb|escribió|a écrit) ?:[ \\t]*$'"
ORACLE = rf"""WITH RECURSIVE
m AS (SELECT conv_id, turn, role, text, string_split(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(10)) AS ls FROM conversations),
d AS (SELECT DISTINCT conv_id, turn, text, ls FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
n AS (SELECT conv_id, turn, text, i, ls[i] AS line, ls[i + 1] AS after FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d)),
l AS (SELECT conv_id, turn, text, i, {_L.format('line')} AS level,
        trim(lower(regexp_replace(regexp_replace(line, '^[ \t]*(>[> \t]*)', ''), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))) AS words,
        coalesce({_L.format('line')} = 0 AND regexp_matches(line, {_INTRO}) AND {_L.format('after')} > 0, false) AS intro FROM n),
k AS (SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY conv_id, turn, text ORDER BY i) THEN 0 ELSE 1 END AS first FROM l WHERE words <> '' AND NOT intro),
g AS (SELECT *, sum(first) OVER (PARTITION BY conv_id, turn, text ORDER BY i) AS pn FROM k),
p AS (SELECT conv_id, turn, text, pn, level, string_split(string_agg(words, ' ' ORDER BY i), ' ') AS ws FROM g GROUP BY ALL),
w AS (SELECT conv_id, turn, text, pn, level, least(len(ws), {WORDS}) AS size,
        unnest(list_transform(range(1, greatest(len(ws) - {WORDS} + 2, 2)), lambda j: array_to_string(ws[j:j + {WORDS} - 1], ' '))) AS w FROM p),
o AS (SELECT conv_id, turn, size, w FROM w WHERE level = 0 UNION
      SELECT conv_id, turn, len(string_split(words, ' ')), words FROM k WHERE level = 0 AND len(string_split(words, ' ')) < {WORDS}),
h AS (SELECT conv_id, w, size, min(turn) AS here FROM o GROUP BY ALL),
f AS (SELECT w, list({{'c': conv_id, 't': here}} ORDER BY conv_id) AS convs FROM h WHERE size >= {FAR_WORDS} GROUP BY w),
q AS (SELECT x.conv_id, x.turn, text, pn, level, CASE WHEN here < x.turn THEN {{'c': x.conv_id, 't': here}} ELSE list_filter(convs, lambda z: z.c <> x.conv_id)[1] END AS orig
      FROM (SELECT * FROM w WHERE level > 0) x LEFT JOIN h ON h.conv_id = x.conv_id AND h.w = x.w LEFT JOIN f ON f.w = x.w),
qn AS (SELECT conv_id, turn, text, pn, level, orig, count(*) AS n FROM q GROUP BY ALL),
qr AS (SELECT *, sum(n) OVER (PARTITION BY conv_id, turn, text, pn) AS every,
        row_number() OVER (PARTITION BY conv_id, turn, text, pn ORDER BY orig IS NULL, n DESC, orig.c <> conv_id, orig.c, orig.t) AS r FROM qn),
qb AS (SELECT conv_id, turn, level, n, CASE WHEN n * {LINK_SHARE} >= every THEN orig END AS orig FROM qr WHERE r = 1),
t AS (SELECT conv_id, turn, max(level) AS levels, count(*) AS n_quoted, count(orig) AS n_linked FROM qb GROUP BY ALL),
v AS (SELECT conv_id, turn, orig, row_number() OVER (PARTITION BY conv_id, turn ORDER BY n DESC, orig) AS r
      FROM (SELECT conv_id, turn, orig, sum(n) AS n FROM qb WHERE level = 1 AND orig IS NOT NULL GROUP BY ALL)),
b AS (SELECT DISTINCT conv_id, turn FROM d),
a AS (SELECT b.conv_id, b.turn, coalesce(CASE WHEN orig.c = b.conv_id THEN orig.t END, e.turn) AS reply_to, orig
      FROM b LEFT JOIN (SELECT * FROM v WHERE r = 1) v ON v.conv_id = b.conv_id AND v.turn = b.turn LEFT JOIN b e ON e.conv_id = b.conv_id AND e.turn = b.turn - 1),
tree AS (SELECT conv_id, turn, turn AS thread, 0::BIGINT AS depth FROM a WHERE reply_to IS NULL
      UNION ALL SELECT a.conv_id, a.turn, thread, depth + 1 FROM tree JOIN a ON a.conv_id = tree.conv_id AND a.reply_to = tree.turn)
SELECT m.conv_id::BIGINT AS conv_id, m.turn::BIGINT AS turn, role,
  regexp_replace(array_to_string(list_filter(ls, lambda x, i: {_L.format('x')} = 0 AND NOT (regexp_matches(x, {_INTRO})
    AND i < len(ls) AND {_L.format('ls[i + 1]')} > 0)), chr(10)), '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g') AS own_text,
  coalesce(levels, 0)::BIGINT AS levels, coalesce(n_quoted, 0)::BIGINT AS n_quoted, coalesce(n_linked, 0)::BIGINT AS n_linked,
  a.reply_to::BIGINT AS reply_to, a.orig.c::BIGINT AS from_conv, a.orig.t::BIGINT AS from_turn, thread::BIGINT AS thread, depth
FROM m LEFT JOIN t ON t.conv_id = m.conv_id AND t.turn = m.turn LEFT JOIN a ON a.conv_id = m.conv_id AND a.turn = m.turn
  LEFT JOIN tree ON tree.conv_id = m.conv_id AND tree.turn = m.turn"""
