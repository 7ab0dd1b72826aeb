"""Line-first quality rules, in DataFrame functions only.

Each line is judged by punctuation, navigation and boilerplate rules; failing
lines go (of a long line only the sentence with boilerplate), and a document losing more than ``max_loss`` of its words is rejected.
Null and empty texts have no words (``base_failed``); repeated rows and rows
with null ids are judged alike, one result each.  Columns other than ``doc_id``
and ``text`` are not read, so their names cannot clash.  The work is one
map-only pass: no shuffle, no state beyond one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE_WORD, let

# No group is repeated in these: java.util.regex matches such groups by recursion, which a long line overflows.
NAVIGATION = r"(?i)^\s*(home|menu|next|previous|back|skip to content|sitemap|log ?in|sign ?up|share|search)\s*([|>/»•]|$)"
BOILERPLATE = r"(?i)(lorem ipsum|javascript (is|must be)|enable javascript|use of cookies|uses cookies|cookie policy|privacy policy|terms of (use|service)|subscribe to our newsletter)"
WINDOW = 8


# What a text must hold for a line of it to be separators() or to match BOILERPLATE.
HOLDS = ["|", "»", "•", "lorem ipsum", "javascript", "cookie", "privacy policy", "terms of", "newsletter"]
# A line of mostly signs, or of repeated marks, has a word that begins with a sign or two signs side by side.
# Combining marks (vowel signs of many scripts) belong to the letters.
SIGNS = r"(?<!\S)[^\p{L}\p{M}\p{N}\s]|[^\p{L}\p{M}\p{N}\s]{2}"
# Boilerplate takes a line of at most SHORT words; of a longer line its sentence of at most LONG words.
SHORT, LONG = 20, 40
SENTENCES = r"(?<=[.!?\u2026\u0964\u104B]['\")\]\u201D]?\s{1,9})(?=\S)|(?<=[\u3002\uFF01\uFF1F])(?=\S)"


def may_fail(text: Column) -> Column:
    """False only where no line can fail by signs, separators or boilerplate: one look at the whole text."""
    held = F.lower(text)
    found = text.rlike(SIGNS)
    for x in HOLDS:
        found = found | F.contains(held, F.lit(x))
    return found


def parts(line: Column, marks: str) -> Column:
    return F.transform(F.split(line, marks), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))


def navigation(line: Column) -> Column:
    """A navigation word, alone or with a tail of single words between marks."""
    def tail(p: Column) -> Column:
        return F.forall(F.slice(p, 2, F.size(p)), lambda x: ~x.rlike(r"\s")) & ((F.size(p) == 1) | (F.element_at(p, -1) != ""))

    return F.when(line.rlike(NAVIGATION), let(parts(line, "[|>/»•]"), tail)).otherwise(F.lit(False))


def separators(line: Column) -> Column:
    """Three or more parts of one or two words between marks."""
    def short(p: Column) -> Column:
        return (F.size(F.filter(p, lambda x: x != "")) >= 3) & F.forall(p, lambda x: F.size(F.split(x, r"\s+")) <= 2)

    return F.when(line.rlike("[|»•]"), let(parts(line, "[|»•]"), short)).otherwise(F.lit(False))


def line_fails(line: Column) -> Column:
    """Punctuation (mostly signs, or repeated shouting marks) or navigation."""
    chars = F.length(F.regexp_replace(line, r"\s", ""))
    letters = F.length(F.regexp_replace(line, r"[^\p{L}\p{M}\p{N}]", ""))
    marks = F.size(F.split(line, r"[!#*$%&|<>=~^?]{2,}")) - 1
    spaces = F.size(F.split(line, r"\s+"))
    punctuation = (chars > 0) & ((letters * 2 < chars) | ((spaces >= 4) & (marks * 2 > spaces)))
    return punctuation | navigation(line) | separators(line)


def n_words_of(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def cleaned(line: Column) -> Column:
    """The line without boilerplate; null where the whole line goes."""
    def left(x: Column) -> Column:
        kept = F.filter(F.split(x, SENTENCES), lambda s: ~(s.rlike(BOILERPLATE) & (n_words_of(s) <= LONG)))
        return let(F.rtrim(F.array_join(kept, "")), lambda k: F.when(k != "", k))

    said = F.when(n_words_of(line) > SHORT, left(line))
    return F.when(line_fails(line), None).when(line.rlike(BOILERPLATE), said).otherwise(line)


def repeat_words(tokens: Column) -> Column:
    """Words inside an 8-word window that occurs twice or more in the text.

    Windows are told apart by a 64-bit hash within one text.  Positions of
    repeated windows come from one sort of (hash, position); their union is
    summed from the gaps between neighbouring positions.
    """
    def covered(at: Column) -> Column:
        return F.aggregate(at, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
                           lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
                           lambda a: a["n"])

    def positions(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"])))

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(positions(h))))

    return let(tokens, lambda w: F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(of(w)))


def tokens(text: Column) -> Column:
    """Words of a text: it is cut at white space, which the ends do not have."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def quality_rules(docs: DataFrame, max_loss: float = 0.5, whole_row: bool = False) -> DataFrame:
    """With ``whole_row`` also the input row as struct ``row``.  Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, n_lines_removed, n_words_removed, cleaned_text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    space = r"[\x20\x09-\x0D]+"
    row = ["row"] if whole_row else []
    base = docs.select(*(F.expr("struct(*)").alias(x) for x in row), "doc_id", F.col("text"), tokens(text).alias("_w"),
                       F.filter(F.split(text, "\n"), lambda x: x.rlike(SPACE_WORD)).alias("_l"),
                       F.split(text, "\n").alias("_all"))
    base = base.select("*", F.when(may_fail(text), F.filter(F.transform("_all", cleaned), lambda x: x.isNotNull()))
                       .otherwise(F.filter("_all", lambda x: ~navigation(x))).alias("_good"), F.size("_w").cast("long").alias("n_words"))
    base = base.select("*", F.when(F.col("_good") == F.col("_all"), F.col("text")).otherwise(F.array_join("_good", "\n")).alias("cleaned_text"))
    out = base.select(
        *row, "doc_id", "n_words",
        F.length(F.regexp_replace(text, space, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_w")).cast("long").alias("n_repeat_words"),
        (F.size("_all") - F.size("_good")).cast("long").alias("n_lines_removed"),
        F.when(F.col("_good") == F.col("_all"), F.lit(0)).otherwise(F.col("n_words") - n_words_of(F.col("cleaned_text"))).cast("long").alias("n_words_removed"),
        "cleaned_text")
    out = out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("n_words_removed") <= max_loss * F.col("n_words")))
