"""Pages of text: status, masking, prefilter, rules, requests to a model outside, signals, golden samples and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.values import unit_hash

# What counts as personal data, and the tokens that take its place.
EMAIL = r"(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)+"
PHONE_WORDS = ("telefon", "tel", "fax", "kom")
COUNTRY = "+48"
PESEL = r"(?<!\d)\d{11}(?!\d)"
TOKENS = {"email": "[EMAIL]", "phone": "[PHONE]", "pesel": "[PESEL]", "person": "[PERSON]"}


# A phone number has 7 to 15 digits, one separator at most between two, and stands behind one of the words or a country code.
_DIGITS = r"\(?(?:\d[().\s-]?){6,14}\d"
_CODE = COUNTRY.replace("+", r"\+") + r"[-\s]?"
PHONE = "(?i)" + rf"(\b(?:{'|'.join(PHONE_WORDS)})\b[.]?[:]?\s*)(?:{_CODE})?{_DIGITS}" + "|" + _CODE + _DIGITS


def page_status(text: Column, least: int = 200) -> Column:
    """text from ``least`` characters on, needs_ocr without any, else sparse; white space is normalised first."""
    n = F.length(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))
    return F.when(n >= least, "text").when(n == 0, "needs_ocr").otherwise("sparse")


def masked(text: Column, persons: Column | None = None) -> Column:
    """Person names, addresses, phone numbers and national numbers by their tokens: the span that starts first, of those that start
    together the longest name, then in that order. Spans never overlap; the words before a phone number stay.

    Names come from a recogniser outside (an array column); none is shipped here.
    """
    kinds = [EMAIL, PHONE, PESEL]
    if persons is None:
        pattern = F.lit("|".join(f"(?:{k})" for k in kinds))
        is_person = lambda m: F.lit(False)
    else:
        known = F.filter(F.array_distinct(F.coalesce(persons, F.array().cast("array<string>"))), lambda p: p.isNotNull() & (p != ""))
        longest = F.array_sort(known, lambda a, b: F.length(b) - F.length(a))
        # A name is taken as it stands, whatever characters it has.
        quoted = F.transform(longest, lambda p: F.concat(F.lit("\\Q"), F.replace(p, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
        pattern = F.concat_ws("|", quoted, *[F.lit(f"(?:{k})") for k in kinds])
        is_person = lambda m: F.array_contains(known, m)
    whole = F.coalesce(text, F.lit(""))
    found = F.regexp_extract_all(whole, pattern, F.lit(0))
    between = F.split(whole, pattern, -1)

    def token(m: Column) -> Column:
        phone = F.concat(F.coalesce(F.regexp_extract(m, r"(?i)^((?:" + "|".join(PHONE_WORDS) + r")\b[.]?[:]?\s*)", 1), F.lit("")), F.lit(TOKENS["phone"]))
        return F.when(is_person(m), F.lit(TOKENS["person"])).when(m.rlike("^(?:" + EMAIL + ")$"), F.lit(TOKENS["email"])).when(m.rlike("^" + PESEL + "$"), F.lit(TOKENS["pesel"])).otherwise(phone)

    parts = F.zip_with(between, F.concat(F.transform(found, token), F.array(F.lit(""))), lambda b, t: F.concat(b, t))
    return F.when(text.isNotNull(), F.when(F.size(found) > 0, F.array_join(parts, "")).otherwise(text))


def personal_data(text: Column) -> Column:
    """The kinds of personal data that a text still holds."""
    found = F.array(F.when(text.rlike(EMAIL), "email"), F.when(text.rlike(PHONE), "phone"), F.when(text.rlike(PESEL), "pesel"))
    return F.filter(found, lambda x: x.isNotNull())


def sentences(text: Column) -> Column:
    """Sentences of lower-case words; lemmas from an analyser outside may take the words' place."""
    return F.filter(F.transform(F.split(F.lower(text), r"[.!?\n]+"), lambda s: F.filter(F.split(F.trim(s), r"[^\p{L}\p{N}]+"), lambda w: w != "")), lambda ws: F.size(ws) > 0)


def term_matches(words: Column, term: list[str]) -> Column:
    """Whether every word of a term is in one sentence; a word is alternatives by ``|``, each whole or a ``stem*``."""
    out = F.lit(True)
    for word in term:
        out = out & F.exists(words, _alternatives(word.split("|")))
    return out


def _alternatives(options: list[str]):
    exact = [a for a in options if not a.endswith("*")]
    stems = [a[:-1] for a in options if a.endswith("*")]

    def fits(w: Column) -> Column:
        test = w.isin(*exact) if exact else F.lit(False)
        for s in stems:
            test = test | w.startswith(s)
        return test

    return fits


def prefilter_hits(pages: DataFrame, key: str, text: str, signals: dict[str, list[list[str]]]) -> DataFrame:
    """(key, signal, term, sentence) for every term that a sentence matches."""
    rows = pages.select(key, F.posexplode(sentences(F.col(text))).alias("sentence", "words"))
    flags = [F.struct(F.lit(s).alias("signal"), F.lit(i).alias("term"), term_matches(F.col("words"), term).alias("hit")) for s, terms in signals.items() for i, term in enumerate(terms)]
    return rows.select(key, "sentence", F.explode(F.array(*flags)).alias("f")).filter("f.hit").select(key, "f.signal", "f.term", "sentence")


def first_rule(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The class of the first rule, in order of severity, whose pattern the text matches; struct of class and where."""
    out = F.lit(None).cast("struct<rule:string,at:int>")
    for name, pattern in reversed(rules):
        at = F.regexp_instr(text, F.lit(pattern))
        out = F.when(at > 0, F.struct(F.lit(name).alias("rule"), at.cast("int").alias("at"))).otherwise(out)
    return out


def single_number(text: Column, pattern: str) -> Column:
    """The one number a text names; null where it names none or several."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def requests(pages: DataFrame, prompt: Column, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages with ``request_key``, requests to send): equal requests once, and none that the response store has."""
    keyed = pages.withColumn("request_key", F.sha2(prompt, 256)).withColumn("prompt", prompt)
    new = keyed.select("request_key", "prompt").dropDuplicates(["request_key"]).join(stored.select("request_key"), "request_key", "left_anti")
    return keyed.drop("prompt"), new


def judged(answers: DataFrame, page_text: str, evidence: str, value: str, allowed: list[str]) -> DataFrame:
    """Adds why an answer is discarded: no value, a value that isn't allowed, or evidence that isn't verbatim on the page."""
    here = F.instr(F.regexp_replace(F.col(page_text), r"\s+", " "), F.regexp_replace(F.col(evidence), r"\s+", " ")) > 0
    why = F.when(F.col(value).isNull(), "no_value").when(~F.col(value).isin(*allowed), "value_not_allowed").when(F.col(evidence).isNull() | ~here, "evidence_not_on_page")
    return answers.withColumn("discard_reason", why)


def file_coverage(pages: DataFrame, file: list[str]) -> DataFrame:
    """Status of each file: read, partial, not_run or no_text, from page flags ``has_text`` and ``done``."""
    counted = pages.groupBy(*file).agg(F.count_if("has_text").alias("n_text"), F.count_if(F.col("has_text") & F.col("done")).alias("n_done"))
    return counted.withColumn("status", F.when(F.col("n_text") == 0, "no_text").when(F.col("n_done") == 0, "not_run").when(F.col("n_done") < F.col("n_text"), "partial").otherwise("read"))


def hash_sample(rows: DataFrame, key: str, rate: Column, seed: str) -> DataFrame:
    """Rows whose hash in [0, 1) is under their rate, with the draw's position u / rate."""
    drawn = rows.withColumn("u", unit_hash(F.col(key), seed=seed))
    return drawn.filter(F.col("u") < rate).withColumn("draw_position", F.col("u") / rate)


def prediction_scores(rows: DataFrame, truth: str, said: str, by: list[str]) -> DataFrame:
    """Precision, recall and F1; a wrong value counts as a false positive and a false negative."""
    t, s = F.col(truth), F.col(said)
    counted = rows.groupBy(*by).agg(F.count_if(t.isNotNull() & (t == s)).alias("tp"), F.count_if(s.isNotNull() & ~s.eqNullSafe(t)).alias("fp"), F.count_if(t.isNotNull() & ~t.eqNullSafe(s)).alias("fn"))
    p, r = F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0)), F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))
    return counted.withColumn("precision", p).withColumn("recall", r).withColumn("f1", 2 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0)))


def mcnemar(rows: DataFrame, before: str, after: str) -> DataFrame:
    """Pairs lost and won, and the exact two-sided p of McNemar's test: the binomial tail over lost + won at one half."""
    counted = rows.agg(F.count_if(F.col(before) & ~F.col(after)).alias("lost"), F.count_if(~F.col(before) & F.col(after)).alias("won"))
    n, k = F.col("lost") + F.col("won"), F.least("lost", "won")
    log_choose = lambda i: F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(i, F.lit(1).cast("long"))), F.lit(0.0), lambda a, j: F.when(j <= i, a + F.log((n - j + 1) / j)).otherwise(a))
    tail = F.aggregate(F.sequence(F.lit(0).cast("long"), k), F.lit(0.0), lambda a, i: a + F.exp(log_choose(i) - n * F.log(F.lit(2.0))))
    return counted.withColumn("p_value", F.when(n == 0, 1.0).otherwise(F.least(F.lit(1.0), 2 * tail)))


def labelled_prefix(queue: DataFrame, order: str, done: str) -> DataFrame:
    """The rows of a draw before its first unlabelled one."""
    first = queue.agg(F.min(F.when(~F.col(done), F.col(order))).alias("_first"))
    # One row with one number.
    return queue.crossJoin(F.broadcast(first)).filter(F.col("_first").isNull() | (F.col(order) < F.col("_first"))).drop("_first")
