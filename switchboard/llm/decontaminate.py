"""Benchmark decontamination by template windows (operator 8), in DataFrame functions only.

Texts are canonicalised word by word: numbers, units after numbers, and
capitalised words inside a sentence become the placeholders <n>, <u> and <p>;
the other words are lower-cased. A text with such names is matched in a second
form as well that keeps them as lower-cased words, so that changed letter case
hides nothing. In a third form every capitalised word is a name, also where a sentence
or line starts, and runs of names, and numbers with their units, are one placeholder.
Items with windows of mostly placeholders are matched by their words as they stand, too. Hashes of windows of WINDOW canonical words
are joined by equality with the windows of the benchmark, so a question with
other numbers or names is found as well. Matches of a document and an item are
counted per diagonal (difference of the two word positions), which needs no
gathering of windows. The slots must be consistent: one value of the item always
stands for one value in the document. This is asked of all matching stretches of
a diagonal together and of each by itself; words equal as they stand need none.

A document leaks an item when a consistent diagonal or stretch, or what is equal
word for word, matches at least COVER words of it, or the whole item if that is shorter.

Defined results
  null or empty text, fewer words than a window    no match
  items of fewer than MIN_WORDS words              never match; windows of nothing but placeholders neither
  mostly placeholders                              found as they stand, or by the other windows of the item
  items shorter than WINDOW                        match as one window of their own length
  very long text                                   processed whole
  repeated rows                                    equal rows give one result row
  null ids                                         kept as null; ``drop_leaks`` treats them like any other id
  empty tables                                     an empty result, or all documents kept
  extra columns                                    ``drop_leaks`` returns the columns of its input
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.llm.common import row_key, settle, without_rows

WINDOW = 8
COVER = 13
MIN_WORDS = 5
# The benchmark side is broadcast up to this many windows of 40 bytes; beyond it the join shuffles.
BROADCAST_WINDOWS = 200_000

# Unit words that follow a number.
UNITS = ("% mm cm dm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz ml cl l liter liters "
         "litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month "
         "months year years cent cents dollar dollars euro euros pound pounds mph kmh degrees watt watts volt volts").split()

_NUMBER = r"[0-9]+(?:[.,:/][0-9]+)*"
_CURRENCY = r"[$€£](?=<n>)"
# A capitalised word after a word that ends no sentence.
_NAME = r"\p{Lu}(?<=[\p{Ll}\p{N},;:)] \p{Lu})[\p{L}'’-]*"
# Runs of capitalised words, and a number with its unit, become one word of the folded form, glued by this character.
_GLUE = "\x02"
_UNITS_AT = "(?:" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + r")(?![\p{L}\p{N}])"
_UNIT = r"(?<=<n> ?)" + _UNITS_AT
_NAME_RUN = r"(?<![\p{L}\p{N}])(\p{Lu}[\p{L}'’-]*) +(?=\p{Lu})"
_CAPITAL = rf"(?<![\p{{L}}\p{{N}}{_GLUE}])\p{{Lu}}[\p{{L}}'’{_GLUE}-]*"
# What is a placeholder in the words as they stand: numbers, with signs or a unit.
_NOT_A_WORD = rf"^[$€£]?[0-9][0-9_]*(?:{_UNITS_AT})?$|^{_UNITS_AT}$"
# What separates words besides the space; signs inside a number are replaced before.
_BREAK = r"[\x09-\x0D.,;:!?]+"


def _split(text: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(text, _BREAK, " "), " "), "")


def _words(text: Column) -> Column:
    """Words of a text as they stand; signs inside numbers become underscores."""
    return _split(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?<=[0-9])[.,:/](?=[0-9])", "_"))


def _canonical(text: Column) -> Column:
    """Words of a text with placeholders for numbers and units; each replacement stays inside a word."""
    marked = text
    for pattern, mark in ((_NUMBER, "<n>"), (_CURRENCY, "<u>"), (_UNIT, "<u>")):
        marked = F.regexp_replace(marked, pattern, mark)
    return _split(F.lower(F.when(text.rlike("[0-9]"), marked).otherwise(text)))


# Forms of a text: names as plain words, names as placeholders, every capitalised word a name and runs folded, words as they stand.
PLAIN, NAMED, FOLDED, LITERAL = range(4)


def _folded(text: Column) -> Column:
    """The text with runs of capitalised words, and numbers with their units, glued to one word each."""
    glued = F.regexp_replace(F.regexp_replace(text, _GLUE, "\x03"), _NAME_RUN, f"$1{_GLUE}")
    return F.when(text.rlike("[0-9]"), F.regexp_replace(glued, f"(?<=[0-9]) (?={_UNITS_AT})", _GLUE)).otherwise(glued)


def _folded_tokens(folded: Column) -> Column:
    named = F.regexp_replace(folded, _CAPITAL, "<p>")
    marked = F.regexp_replace(F.regexp_replace(named, f"{_NUMBER}(?:{_GLUE}?{_UNITS_AT})?", "<n>"), _CURRENCY, "<u>")
    return _split(F.lower(F.when(folded.rlike("[0-9]"), marked).otherwise(named)))


def _with_folded(frame: DataFrame) -> DataFrame:
    """``frame`` with text never null, and its folded text as a column, so that it is computed once."""
    return frame.withColumn("text", F.coalesce(F.col("text"), F.lit(""))).withColumn("_folded", _folded(F.col("text")))


def _tokens(form: int) -> Column:
    """Canonical words of a row of ``_with_folded`` in a form."""
    t = F.col("text")
    if form == FOLDED:
        return _folded_tokens(F.col("_folded"))
    return _words(F.lower(t)) if form == LITERAL else _canonical(F.regexp_replace(t, _NAME, "<p>") if form == NAMED else t)


def _raw(form: Column) -> Column:
    """Words as they stand of a row of ``_with_folded``: as many as its canonical ones."""
    return _words(F.when(form == FOLDED, F.col("_folded")).otherwise(F.col("text")))


def _templates(frame: DataFrame, literal: bool) -> DataFrame:
    """form and tokens for each form of a row of ``_with_folded`` that can match anything the first one does not."""
    t = F.col("text")
    need = {NAMED: t.rlike(_NAME), FOLDED: t.rlike(r"\p{Lu}|[0-9]"), LITERAL: t.rlike("[0-9]")}
    forms = [F.struct(F.lit(PLAIN).alias("form"), _tokens(PLAIN).alias("tokens"))] + [
        F.when(need[f], F.struct(F.lit(f).alias("form"), _tokens(f).alias("tokens")))
        for f in ((NAMED, FOLDED, LITERAL) if literal else (NAMED, FOLDED))]
    rest = [c for c in frame.columns if c not in ("text", "_folded")]
    return frame.select(*rest, F.explode(F.array(*forms)).alias("_f")).where("_f IS NOT NULL").select(
        *rest, "_f.form", "_f.tokens")


def _windows(frame: DataFrame, words: str, lengths: list[int]) -> DataFrame:
    """``frame`` without its words, one row per run of one of the lengths: position and hash.

    The words are laid beside themselves, shifted by one each, and exploded,
    so that hashing runs in generated code.
    """
    widest = max(lengths)
    rest = [c for c in frame.columns if c != words]
    shifted = [F.slice(words, k + 1, F.greatest(F.size(words), F.lit(1))).alias(f"w{k}") for k in range(widest)]
    run = frame.select(*rest, F.posexplode(F.arrays_zip(*shifted)).alias("pos", "_x")).select(
        *rest, "pos", *(F.col(f"_x.w{k}").alias(f"_w{k}") for k in range(widest)))
    one = [F.when(F.col(f"_w{n - 1}").isNotNull(), F.xxhash64(F.lit(n), "form", *(f"_w{k}" for k in range(n)))) for n in lengths]
    window = one[0] if len(one) == 1 else F.explode(F.array(*one))
    return run.select(*rest, "pos", window.alias("window")).where("window IS NOT NULL")


def _place(at: Column) -> Column:
    """Number of words as they stand before word ``at`` of the matched form."""
    before = F.slice("_raw", F.lit(1), at)
    return at + F.aggregate(before, F.lit(0), lambda n, w: n + F.length(w) - F.length(F.translate(w, _GLUE, "")))


def _verified(lines: DataFrame, need: Column) -> DataFrame:
    """The diagonals that leak, with n_windows, at and changed_slots, judged on the words of both sides.

    Stretches are the runs of equal canonical words that hold a window. A
    diagonal leaks if all its stretches together are consistent and long
    enough, if one of them is, or if enough windows are equal word for word:
    a copy with one number edited stays a copy.
    """
    width = F.least(F.lit(WINDOW), F.size("tokens"))
    places = F.sequence(F.lit(0), F.size("tokens") - 1)

    def stretches(equal: str) -> Column:
        def edge(step: int) -> Column:
            return F.filter(places, lambda q: F.get(equal, q) & ~F.coalesce(F.get(equal, q + step), F.lit(False)))
        runs = F.arrays_zip(edge(-1).alias("s"), edge(1).alias("e"))
        return F.filter(runs, lambda r: r["e"] - r["s"] + 1 >= width)

    def windows(runs: str) -> Column:
        return F.aggregate(runs, F.lit(0), lambda n, r: n + r["e"] - r["s"] + 2 - width)

    def slots(run: Column) -> Column:
        return F.transform(F.filter(F.sequence(run["s"], run["e"]), lambda q: F.get("tokens", q).contains("<")), lambda q: F.struct(
            F.get("raw", q).alias("a"), F.get("_raw", q + F.col("shift")).alias("b")))

    def consistent(pairs: Column) -> Column:
        distinct = F.array_distinct(pairs)
        return F.size(F.array_distinct(F.transform(distinct, lambda p: p["a"]))) == F.size(distinct)

    judged = lines.withColumn("_same", F.transform(places, lambda q: F.coalesce(
        F.get("tokens", q) == F.get("_doc", q + F.col("shift")), F.lit(False)))).withColumn(
        "_literal", F.transform(places, lambda q: F.coalesce(
            F.lower(F.get("raw", q)) == F.lower(F.get("_raw", q + F.col("shift"))), F.lit(False)))).withColumn(
        "_runs", stretches("_same")).withColumn("_copied", stretches("_literal")).withColumn(
        "_slots", F.transform("_runs", lambda r: F.struct(
            (r["e"] - r["s"] + 2 - width).alias("n"), slots(r).alias("pairs")))).withColumn(
        "_pairs", F.flatten(F.transform("_slots", lambda r: r["pairs"]))).withColumn(
        "n_windows", F.greatest(
            F.when(consistent(F.col("_pairs")), windows("_runs")).otherwise(F.lit(0)), windows("_copied"),
            F.coalesce(F.array_max(F.transform("_slots", lambda r: F.when(consistent(r["pairs"]), r["n"]))), F.lit(0))))
    return judged.where(F.col("n_windows") >= need).select(
        "doc_id", "key", "item_id", "n_windows", _place(F.least(
            F.get("_runs", F.lit(0))["s"], F.get("_copied", F.lit(0))["s"]) + F.col("shift")).alias("at"),
        F.size(F.filter("_pairs", lambda p: p["a"] != p["b"])).alias("changed_slots"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, key, item_id, n_windows, position, changed_slots: the items that each document leaks."""
    spark = docs.sparkSession
    items = settle(
        _templates(_with_folded(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct())
                   .withColumn("item", F.xxhash64("item_id", "text"))
                   .withColumn("_raws", F.array(_raw(F.lit(PLAIN)), _raw(F.lit(FOLDED)))), literal=True)
        .select("item_id", "item", "form", "tokens", F.xxhash64("item", "form").alias("item_key"),
                F.get("_raws", (F.col("form") == FOLDED).cast("int")).alias("raw"),
                F.exists("tokens", lambda w: w.contains("<")).alias("slotted"))
        # without placeholders a form is the first one again
        .where(F.col("form").isin(PLAIN, LITERAL) | F.col("slotted"))
        .where(F.size("tokens") >= MIN_WORDS), "leak-items")
    empty = spark.createDataFrame([], "doc_id long, key long, item_id long, n_windows long, position long, changed_slots int")
    lengths = [r[0] for r in items.select(F.least(F.size("tokens"), F.lit(WINDOW))).distinct().collect()]  # at most WINDOW
    if not lengths:
        return empty
    own_length = F.least(F.size("tokens"), F.lit(WINDOW))
    runs = None
    for n in lengths:
        some = _windows(items.where(own_length == n).select(
            "item", "item_key", "form", "tokens", F.col("tokens").alias("_t")), "_t", [n])
        words = F.filter(F.slice("tokens", F.col("pos") + 1, n), lambda w: F.when(
            F.col("form") == LITERAL, ~w.rlike(_NOT_A_WORD)).otherwise(~w.contains("<")))
        some = some.select("item", "item_key", "form", F.col("pos").alias("at"), "window",
                           (2 * F.size(words) >= n).alias("wordy"), (F.size(words) > 0).alias("some"))
        runs = some if runs is None else runs.unionByName(some)
    runs = settle(runs, "leak-runs")
    # words as they stand are matched for items that have windows of mostly placeholders
    heavy = runs.where((F.col("form") == PLAIN) & ~F.col("wordy")).select("item").distinct()
    exact = runs.where((F.col("form") == LITERAL) & F.col("some")).join(heavy, "item", "left_semi")
    wanted = settle(runs.where((F.col("form") != LITERAL) & F.col("wordy")).unionByName(exact).select(
        "item_key", "form", "at", "window"), "leak-windows")
    sizes = {r["form"]: r["count"] for r in wanted.groupBy("form").count().collect()}
    n_wanted = sum(sizes.values())
    if not n_wanted:
        return empty
    literal = LITERAL in sizes
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text")
    forms = _templates(_with_folded(own), literal)
    found = _windows(forms, "tokens", sorted(lengths)).drop("form")
    wanted = wanted.drop("form")
    hits = found.join(F.broadcast(wanted) if n_wanted <= BROADCAST_WINDOWS else wanted, "window")
    need = F.least(F.lit(COVER), F.size("tokens")) - F.least(F.lit(WINDOW), F.size("tokens")) + 1
    # equal rows count once: their windows fall on the same positions
    lines = hits.groupBy("doc_id", "key", "item_key", (F.col("pos") - F.col("at")).alias("shift")).agg(
        F.countDistinct("at").alias("n_windows"), F.min("at").alias("at"))
    # an item may have fewer windows to find it by than it needs; the words of both sides decide
    known = items.join(wanted.groupBy("item_key").agg(F.count("*").alias("n_known")), "item_key")
    lines = settle(settle(lines, "leak-lines").join(
        known.select("item_key", "item_id", "form", "raw", "tokens", "slotted", "n_known"), "item_key").where(
        F.col("n_windows") >= F.least(need, F.col("n_known"))), "leak-candidates")
    # without slots there is nothing to judge
    plain = lines.where((F.col("form") == PLAIN) & ~F.col("slotted")).select(
        "doc_id", "key", "item_id", F.col("n_windows").cast("int").alias("n_windows"), (F.col("at") + F.col("shift")).alias("at"),
        F.lit(0).alias("changed_slots"))
    slotted = lines.where((F.col("form") != PLAIN) | F.col("slotted")).drop("at", "n_windows")
    texts = own.join(
        slotted.select(F.col("doc_id").alias("_i"), F.col("key").alias("_k")).distinct(),
        F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("key") == F.col("_k")), "left_semi").dropDuplicates(
        ["doc_id", "key"]).select(F.col("doc_id").alias("_i"), F.col("key").alias("_k"), "text")
    both = _with_folded(slotted.join(texts, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("key") == F.col("_k"))))
    form = F.col("form")
    tokens = F.when(form == PLAIN, _tokens(PLAIN)).when(form == NAMED, _tokens(NAMED)).when(
        form == FOLDED, _tokens(FOLDED)).otherwise(_tokens(LITERAL))
    # exploded, so that the optimizer does not move the splitting into the loops over words
    both = both.withColumn("_d", F.explode(F.array(F.struct(_raw(form).alias("raw"), tokens.alias("doc"))))).withColumn(
        "_raw", F.col("_d.raw")).withColumn("_doc", F.col("_d.doc")).drop("text", "_folded", "_d")
    every = plain.unionByName(_verified(both, need))
    best = every.groupBy("doc_id", "key", "item_id").agg(F.max(F.struct(
        "n_windows", (-F.col("changed_slots")).alias("same"), (-F.col("at")).alias("at"))).alias("b"))
    return best.select("doc_id", "key", "item_id", F.col("b.n_windows").cast("long").alias("n_windows"),
                       (-F.col("b.at")).cast("long").alias("position"), (-F.col("b.same")).cast("int").alias("changed_slots"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, with their columns."""
    return without_rows(docs, leaks(docs, benchmark))
