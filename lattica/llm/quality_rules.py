"""Line-first cleaning: rules for each line, then a verdict on what is left.

A line fails if it is navigation (separators between short items), boilerplate (a
known phrase), or badly punctuated (symbols strewn over it, shouting, or a long
line without any sentence punctuation). Failing lines are removed; a document that
loses more than `max_loss` of its word characters, or all its words, is rejected.
Base measures of the whole text come beside it: words, symbols, repeated lines,
and words in repeated 8-word windows. Everything is DataFrame functions on the
row itself: no shuffle.

A null text is empty: no words, rejected. Repeated rows are judged each, ties do
not arise, an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, MIN_WORDS, MAX_REPEATED, MAX_LOSS = 8, 20, 30, 0.5
SPACE = " \t\n\x0b\x0c\r"

# Symbols that count, separators of menus, phrases of boilerplate in English, German, French and Spanish.
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·"
PHRASES = (
    *("all rights reserved", "licensed under", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies", "uses cookies", "subscribe to our", "sign up for our", "click here", "skip to content", "back to top", "enable javascript", "powered by", "copyright ©", "lorem ipsum"),
    *("alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung", "cookies akzeptieren", "hier klicken", "zum seitenanfang", "javascript aktivieren"),
    *("tous droits réservés", "mentions légales", "politique de confidentialité", "accepter les cookies", "cliquez ici", "retour en haut", "activer javascript"),
    *("todos los derechos reservados", "términos de uso", "política de privacidad", "aceptar cookies", "haga clic aquí", "volver arriba", "activar javascript"),
)


BLANK = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """array<string> of the runs of anything but ASCII white space."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(bare, BLANK))


def with_repeated_words(df: DataFrame, words: str, out: str, window: int = WINDOW) -> DataFrame:
    """Adds the number of words in windows found twice or more.

    Only where some window's hash recurs are the windows sorted with their
    positions: equal neighbours are repeats, and from each repeat to the next at
    most `window` words count. Columns are added one by one, as an expression
    inside a lambda would be evaluated for each element anew.
    """
    n = F.size(words) - F.lit(window) + 1
    hashes = F.when(n >= 2, F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(words, i, window))))
    df = df.withColumn("_h", hashes)
    recurs = F.size("_h") > F.size(F.array_distinct("_h"))
    df = df.withColumn("_s", F.when(recurs, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = F.transform("_s", lambda x, k: F.when((x["h"] == F.get("_s", k - 1)["h"]) | (x["h"] == F.get("_s", k + 1)["h"]), x["i"]))
    at = F.sort_array(F.filter(same, lambda i: i.isNotNull()))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(at, start, lambda a, i: F.struct((i + window).alias("end"), (a["n"] + i + window - F.greatest(i, a["end"])).alias("n")), lambda a: a["n"])
    return df.withColumn(out, F.coalesce(covered, F.lit(0)).cast("long")).drop("_h", "_s")


def _chars(characters: str) -> str:
    return "[" + "".join("\\" + c for c in characters) + "]"


def count_of(text: Column, characters: str) -> Column:
    """Occurrences of any of the characters."""
    return F.length(F.regexp_replace(text, "[^" + _chars(characters)[1:-1] + "]+", "")).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, BLANK, "")).cast("long")


def unpunctuated(line: Column) -> Column:
    """A long line without any sentence punctuation."""
    bare = ~line.rlike(r"""[.,;:!?\u2026\u3002\uFF0C\u3001\uFF01\uFF1F\u061F\u0964"'\u201D\u2019)]""") & line.rlike(r"[^\x20\x09-\x0D]")
    return bare & (F.size(F.split(F.btrim(line, F.lit(SPACE)), BLANK)) >= 25)


def line_fails(line: Column, odd: Column, phrased: Column) -> Column:
    """Whether a line fails a rule; odd, phrased: whether the text has symbols, separators or shouts, or a phrase, at all."""
    n = F.size(F.split(F.btrim(line, F.lit(SPACE)), BLANK))
    menu = count_of(line, SEPARATORS)
    symbols = count_of(line, SYMBOLS)
    shouts = F.size(F.split(line, "!!")) - 1
    navigation = (menu >= 2) & (menu * 5 >= n)
    strewn = (symbols >= 6) & (symbols * 10 > word_chars(line))
    shouting = (shouts >= 3) & (shouts * 3 >= n)
    boilerplate = F.exists(F.array(*map(F.lit, PHRASES)), lambda p: F.contains(F.lower(line), p))
    return (odd & (navigation | strewn | shouting)) | (phrased & boilerplate) | unpunctuated(line)


def judged(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW, min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED, max_loss: float = MAX_LOSS) -> DataFrame:
    """A row per document: own (struct of keep), cleaned (text), the measures, base_failed and kept."""
    text = F.col("text")
    df = docs.select(F.struct(*keep).alias("own"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    df = df.withColumns({"words": words_of(text), "lines": F.split("text", "\n", -1), "n_symbols": count_of(text, SYMBOLS), "low": F.lower("text")})
    phrased = F.lit(False)
    for phrase in PHRASES:
        phrased = phrased | F.contains(F.col("low"), F.lit(phrase))
    df = df.withColumns({"odd": (F.col("n_symbols") >= 2) | F.contains(text, F.lit("!!")) | text.rlike(_chars(SEPARATORS)), "phrased": phrased, "word_chars": F.length(F.array_join("words", "")).cast("long"), "n_words": F.size("words").cast("long")}).drop("low")
    odd, phrased = F.col("odd"), F.col("phrased")  # each used outside the lambda as well: else Catalyst would move its definition inside, to be evaluated for each line
    worded = F.filter("lines", lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumns({"good": F.when(odd | phrased, F.filter("lines", lambda s: ~line_fails(s, odd, phrased))).otherwise(F.filter("lines", lambda s: ~unpunctuated(s))), "worded": worded})
    df = df.withColumn("n_dup_lines", (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long"))
    df = with_repeated_words(df, "words", "n_repeat_words", window)
    whole = F.size("good") == F.size("lines")
    df = df.withColumn("cleaned", F.when(whole, text).otherwise(F.array_join("good", "\n")))
    df = df.withColumn("left", F.when(whole, F.col("word_chars")).otherwise(word_chars(F.col("cleaned"))))
    df = df.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words")))
    kept = ~F.col("base_failed") & (F.col("left") > 0) & (F.col("left") >= (1 - max_loss) * F.col("word_chars"))
    return df.select("own", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "cleaned", "base_failed", kept.alias("kept"))


def filtered(docs: DataFrame, text_col: str = "text", count_col: str | None = "n_chars", **options) -> DataFrame:
    """The documents that stay, their texts cleaned and, if they have it, count_col set anew; other columns as they were."""
    names = docs.columns
    # the running number keeps Catalyst from pushing the filter, and with it all measures, below the columns they are made of
    df = judged(docs, text_col, tuple(names), **options).withColumn("_at", F.monotonically_increasing_id()).where("kept and _at >= 0")
    new = {text_col: F.col("cleaned")} | ({count_col: F.length("cleaned").cast(docs.schema[count_col].dataType)} if count_col in names else {})
    return df.select(*[new.get(n, F.col("own")[n]).alias(n) for n in names])
