"""Secret scans: candidates by pattern, false positives removed by a random forest; DataFrame and SQL functions only.

A candidate is a value behind a credential's name, a token of a known form, a private key from its BEGIN to its END line (to
the end of the text if that is missing), or a long run of letters and digits. Its features: length; shares of digits, capitals and distinct characters; transitions between
character classes; share covered by dictionary words; whether it lies in a path; credential words and words of harmless
values among its neighbours; and its form. A random forest trained on labelled findings (``labelled_findings`` makes a set by
rule; pass your own as ``labelled``) says which are real.

The trained trees become one SQL expression that is applied to each document's array of candidates, so a scan is one pass
over whole texts: no shuffle, no Python, nothing that grows with the number of secrets in one place.

Null and empty texts have no findings; a text of any length is scanned whole; each row is a document, also where ids repeat;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TREES, DEPTH, SEED, CUTOFF, CONTEXT = 20, 5, 11, 0.5, 48

_NAME = r"(?i:\b[A-Za-z0-9_.-]{0,24}(?:key|secret|token|passw(?:or)?d|passwd|pwd|credential|bearer|auth)s?)"
_SIGN = r"[\"']?\s{0,3}(?>:=|=>|:|=|\s)\s{0,3}"
_BLOCK = r"[A-Z0-9 ]{0,20}PRIVATE KEY(?: BLOCK)?-----"
#: What stands after a name and its sign: all between quotes that close on the line, or what runs to a space or a delimiter.
_VALUE = r"(?![=:>\s\"']{0,8}-----BEGIN " + _BLOCK + r")(?:\"(?:[^\"\\\r\n]|\\.){8,}+(?=\")|'(?:[^'\\\r\n]|\\.){8,}+(?=')|[\"']?[^\s\"'`,;()<>\[\]{}|\\]{8,}+)"
#: Kinds of candidates, first that matches; a value is what follows the name and its sign, or the whole match. No value has
#: a greatest length: possessive runs are linear, and what a run refused would not be found again.
KINDS = {
    "private_key": r"-----BEGIN " + _BLOCK + r"(?s:.*?)(?:-----END " + _BLOCK + r"|\z)",
    "known_form": r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|sk-[A-Za-z0-9_-]{20,}+|AIza[0-9A-Za-z_-]{35}|eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)",
    "assigned": _NAME + _SIGN + _VALUE,
    "long_run": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+",
}
CANDIDATE = "|".join(KINDS.values())
WORDS = ("example", "sample", "test", "dummy", "placeholder", "change", "your", "here", "password", "secret", "token", "key", "user", "admin", "name", "value", "string", "none", "null", "true", "false", "file", "path", "config", "default", "public", "private", "version", "number", "index", "select", "from", "where", "this", "that", "with")
NEAR_SECRET = r"(?i)(?<![a-z])(?:\w{0,12}[_-])?(?:key|secret|token|passw|pwd|credential|bearer|auth|login)"
NEAR_HARMLESS = r"(?i)(?<![a-z])(?:example|sample|dummy|placeholder|checksum|sha-?\d+|md5|commit|digest|hash|uuid|version|isbn|doi)(?![a-z])"
FEATURES = ("size", "digits", "capitals", "distinct", "turns", "covered", "in_path", "near_secret", "near_harmless", "form", "hexadecimal")


def _share(value: Column, pattern: str) -> Column:
    """Characters of a value that a pattern matches, over all."""
    return (F.length(value) - F.length(F.regexp_replace(value, F.lit(pattern), F.lit("")))) / F.greatest(F.length(value), F.lit(1))


def value_of(match: Column) -> Column:
    """The value of a candidate, without the name before it."""
    return F.regexp_replace(match, F.lit(r"^" + _NAME + _SIGN + r"[\"']?"), F.lit(""))


def _kind(match: Column) -> Column:
    # A quoted match ends before its closing quote, so the name and sign tell it.
    out = F.when(match.rlike("^" + _NAME + _SIGN), "assigned").otherwise(F.lit("long_run"))
    for name in ("known_form", "private_key"):
        out = F.when(match.rlike("^(?:" + KINDS[name] + ")$"), name).otherwise(out)
    return out


def described(match: Column, left: Column, right: Column) -> list[Column]:
    """The features of a candidate, from its match and its neighbours."""
    value = value_of(match)
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "0"), "[^aB0]", "-")
    turns = F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1
    kind = _kind(match)
    return [
        F.length(value).cast("double").alias("size"),
        _share(value, "[0-9]").alias("digits"),
        _share(value, "[A-Z]").alias("capitals"),
        (F.size(F.array_distinct(F.split(value, ""))) / F.greatest(F.length(value), F.lit(1))).alias("distinct"),
        (turns / F.greatest(F.length(value), F.lit(1))).alias("turns"),
        _share(F.lower(value), "(?:" + "|".join(WORDS) + ")").alias("covered"),
        (left.rlike(r"(?:[/\\]|://\S*|\.\w{1,4}=?)$") | right.rlike(r"^(?:[/\\]|\.\w{1,4}\b)") | value.rlike(r"/.*/.*/")).cast("double").alias("in_path"),
        (F.left(match, F.length(match) - F.length(value)).rlike(NEAR_SECRET) | left.rlike(NEAR_SECRET)).cast("double").alias("near_secret"),
        (left.rlike(NEAR_HARMLESS) | right.rlike(NEAR_HARMLESS) | F.lower(match).rlike(NEAR_HARMLESS)).cast("double").alias("near_harmless"),
        F.when(kind == "private_key", 3.0).when(kind == "known_form", 2.0).when(kind == "assigned", 1.0).otherwise(0.0).alias("form"),
        value.rlike("^[0-9a-fA-F]+$").cast("double").alias("hexadecimal"),
    ]


def labelled_findings(spark: SparkSession, n: int = 4000) -> DataFrame:
    """(match, left, right, label): real and harmless findings by rule, the same in every run."""
    i = F.col("id")
    hexa = F.sha2(F.concat(F.lit("v"), i.cast("string")), 256)
    more = F.sha2(F.concat(F.lit("w"), i.cast("string")), 512)
    base = F.regexp_replace(F.base64(F.unhex(more)), "[^A-Za-z0-9]", "")
    long = F.regexp_replace(F.concat(*[F.base64(F.unhex(F.sha2(F.concat(F.lit(f"x{j}-"), i.cast("string")), 512))) for j in range(8)]), "[^A-Za-z0-9]", "")
    pick = lambda salt, options: F.element_at(F.array(*[F.lit(x) for x in options]), (F.pmod(F.xxhash64(F.lit(salt), i), F.lit(len(options))) + 1).cast("int"))
    name = pick("name", ["api_key", "token", "secret", "password", "auth_token", "AWS_SECRET_ACCESS_KEY", "client_secret", "access_key", "db_password", "bearer"])
    sign = pick("sign", [" = ", "=", ": ", ' = "', '="', ":"])
    left = pick("left", ["", "and then ", "config ", "the value of ", "export ", "la el ", "\n", "und die ", "please set ", ". "])
    right = pick("right", ["", " and", '"', "\n", " la", ".", ";", " is used", " for login", "###"])
    harmless = pick("harm", ["sha256 ", "commit ", "md5: ", "checksum ", "uuid ", "version ", "order ", "isbn ", "digest ", "example "])
    word = pick("word", ["your_password_here", "example-token-value", "changeme-placeholder", "the_default_value", "config.default.name", "test-secret-string", "public_version_number", "sample_user_name_file", "some.module.path.value", "dummy_token_example"])
    size = (F.lit(16) + F.pmod(F.xxhash64(F.lit("size"), i), F.lit(40))).cast("int")
    # One real value in four is long.
    is_long = F.pmod(F.xxhash64(F.lit("long"), i), F.lit(4)) == 0
    long_size = (F.lit(80) + F.pmod(F.xxhash64(F.lit("long_size"), i), F.lit(520))).cast("int")
    base_value = F.when(is_long, F.substring(long, F.lit(1), long_size)).otherwise(F.substring(base, F.lit(1), size))
    # Private keys, bare tokens, and the harmless long runs they are to be told from.
    lines = F.regexp_replace(F.concat(*[F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat(F.lit(f"y{j}-"), i.cast("string")), 512))), r"[=\s]", "") for j in range(10)]), "(.{64})", "$1\n")
    owner = pick("owner", ["", "RSA ", "EC ", "OPENSSH ", "DSA ", "ENCRYPTED "])
    body = F.concat(F.lit("\n"), F.substring(lines, F.lit(1), (F.lit(100) + F.pmod(F.xxhash64(F.lit("lines"), i), F.lit(700))).cast("int")))
    block = F.concat(F.lit("-----BEGIN "), owner, F.lit("PRIVATE KEY-----"), body, F.when(F.pmod(F.xxhash64(F.lit("end"), i), F.lit(6)) > 0, F.concat(F.lit("\n-----END "), owner, F.lit("PRIVATE KEY-----"))).otherwise(F.lit("")))
    raw = F.regexp_replace(F.base64(F.unhex(more)), r"[=\s]", "")
    bare_size = (F.lit(20) + F.pmod(F.xxhash64(F.lit("bare"), i), F.lit(45))).cast("int")
    bare = F.when(is_long, base_value).otherwise(F.element_at(F.array(F.substring(base, F.lit(1), bare_size), F.substring(raw, F.lit(1), bare_size)), (F.pmod(F.xxhash64(F.lit("form"), i), F.lit(2)) + 1).cast("int")))
    plain = [pick(f"plain{j}", ["model", "training", "customer", "document", "weekly", "Summary", "section", "chapter", "region", "table", "results", "Annual", "report", "v2"]) for j in range(4)]
    dash = pick("dash", ["_", "-", "/", ""])
    long_name = F.concat(plain[0], dash, plain[1], dash, plain[2], dash, plain[3], dash, F.pmod(F.xxhash64(F.lit("number"), i), F.lit(3000)).cast("string"))
    kind = F.pmod(i, F.lit(15))
    match = (
        F.when(kind == 0, F.concat(name, sign, F.substring(hexa, F.lit(1), F.element_at(F.array(F.lit(32), F.lit(40), F.lit(64)), (F.pmod(F.xxhash64(i), F.lit(3)) + 1).cast("int")))))
        .when(kind == 1, F.concat(name, sign, base_value))
        .when(kind == 2, F.concat(F.lit("AKIA"), F.upper(F.substring(base, 1, 16))))
        .when(kind == 3, F.concat(F.lit("ghp_"), F.substring(base, 1, 36)))
        .when(kind == 4, F.concat(F.lit("sk-"), F.when(is_long, base_value).otherwise(F.substring(base, 1, 40))))
        .when(kind == 5, F.concat(name, sign, word))
        .when(kind == 6, F.substring(hexa, 1, 40))
        .when(kind == 7, F.concat(pick("dir", ["home/user/", "usr/local/lib/", "var/log/app/", "src/main/java/"]), F.substring(hexa, 1, 8), F.lit("/file")))
        .when(kind == 8, F.regexp_replace(hexa, "[a-f]", "7"))
        .when(kind == 10, block)
        .when(kind == 11, bare)
        .when(kind == 14, F.substring(hexa, F.lit(1), bare_size))
        .when(kind == 12, long_name)
        .when(kind == 13, F.when(is_long, F.regexp_replace(F.substring(hexa, F.lit(1), bare_size), "[a-f]", "3")).otherwise(F.substring(raw, F.lit(1), bare_size)))
        .otherwise(F.concat(F.lit("token "), word))
    )
    real = (kind <= 4) | kind.isin(10, 11, 14)
    label = real.cast("double")
    # One real finding in eight stands beside a harmless word as well, but a bare token there is a checksum or a version.
    before = F.when(kind.isin(6, 8) | ((kind == 13) & ~is_long) | (real & ~kind.isin(11, 14) & (F.pmod(F.xxhash64(F.lit("near"), i), F.lit(8)) == 0)), harmless).when(kind == 7, F.lit("/")).otherwise(left)
    return spark.range(n).select(match.alias("match"), before.alias("left"), right.alias("right"), label.alias("label"))


def train(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED):
    """A random forest on the features of labelled findings (match, left, right, label)."""
    rows = labelled.select("label", *described(F.col("match"), F.col("left"), F.col("right")))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows.coalesce(1).sort("label", *FEATURES))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label").fit(rows.select("label", "features"))


def as_sql(model, of: str) -> str:
    """The share of a forest's trees that vote 1, as an SQL expression on the fields of struct ``of``."""
    lines = [x for x in model.toDebugString.splitlines()[1:] if x.strip()]
    trees: list[list[str]] = []
    for line in lines:
        if line.strip().startswith("Tree "):
            trees.append([])
        else:
            trees[-1].append(line.strip())

    def tree(rest: list[str]) -> str:
        line = rest.pop(0)
        if line.startswith("Predict:"):
            return line.split(":")[1].strip().strip(")")
        feature, limit = re.search(r"feature (\d+) <= ([-\d.eE]+)", line).groups()
        low = tree(rest)
        rest.pop(0)  # Else
        return f"CASE WHEN {of}.{FEATURES[int(feature)]} <= {float(limit)!r}D THEN {low} ELSE {tree(rest)} END"

    return "(" + " + ".join(tree(t) for t in trees) + f") / {len(trees)}.0D"


def scanned(docs: DataFrame, model, text: str = "text", names: tuple[str, str] = ("findings", "pieces")) -> DataFrame:
    """The documents with two more columns under ``names``, which none of theirs may have: an array of findings (n, kind,
    value, start, length, score, match), and the pieces of text between them."""
    findings, pieces = names
    taken = {c.lower() for c in [*docs.columns, *names]}
    own = []
    for name in ("_found", "_near", "_told", "_starts", "_scores"):
        while name in taken:
            name += "_"
        own.append(name)
    found, near, told, starts, scores = own
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.withColumn(found, F.regexp_extract_all(whole, F.lit(f"(?:{CANDIDATE})"), F.lit(0)))
    rows = rows.withColumn(pieces, F.when(F.size(found) > 0, F.split(whole, f"(?:{CANDIDATE})", -1)).otherwise(F.array(whole)))
    left = lambda i: F.right(F.get(F.col(pieces), i), F.lit(CONTEXT))
    right = lambda i: F.left(F.get(F.col(pieces), i + 1), F.lit(CONTEXT))
    rows = rows.withColumn(near, F.transform(found, lambda m, i: F.struct(m.alias("match"), left(i).alias("left"), right(i).alias("right"), i.alias("n"))))
    rows = rows.withColumn(told, F.transform(near, lambda c: F.struct(c["n"].alias("n"), c["match"].alias("match"), *described(c["match"], c["left"], c["right"]))))
    # Where each match starts: lengths of all pieces and matches before it.
    step = lambda acc, x: F.struct((acc["at"] + x["size"]).alias("at"), F.concat(acc["all"], F.array(acc["at"] + x["gap"])).alias("all"))
    sizes = F.transform(found, lambda m, i: F.struct((F.length(F.get(F.col(pieces), i)) + F.length(m)).cast("long").alias("size"), F.length(F.get(F.col(pieces), i)).cast("long").alias("gap")))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("all"))
    rows = rows.withColumn(starts, F.when(F.size(found) > 0, F.aggregate(sizes, zero, step, lambda acc: acc["all"])))
    score = as_sql(model, "c")
    rows = rows.withColumn(scores, F.expr(f"transform({told}, c -> {score})"))

    def finding(c: Column) -> Column:
        value = value_of(c["match"])
        start = F.get(F.col(starts), c["n"]) + F.length(c["match"]) - F.length(value)
        return F.struct(c["n"].alias("n"), _kind(c["match"]).alias("kind"), value.alias("value"), start.cast("long").alias("start"), F.length(value).cast("long").alias("length"), F.get(F.col(scores), c["n"]).alias("score"), c["match"].alias("match"))

    return rows.withColumn(findings, F.transform(told, finding)).drop(*own)


def findings(docs: DataFrame, model, cutoff: float = CUTOFF) -> DataFrame:
    """A row for each candidate: doc_id, n, kind, start, length, value_sha256, score, is_secret."""
    rows = scanned(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select("doc_id", F.explode("findings").alias("f"))
    return rows.select("doc_id", F.col("f.n").cast("long").alias("n"), "f.kind", "f.start", "f.length", F.sha2("f.value", 256).alias("value_sha256"), "f.score", (F.col("f.score") > cutoff).alias("is_secret"))


def redacted(docs: DataFrame, model, cutoff: float = CUTOFF, mark: str = "[SECRET]", text: str = "text") -> DataFrame:
    """The documents with every secret's value replaced by a mark; a text without secrets, and a null, stays as it is."""
    names = []
    for name in ("findings", "pieces"):
        while name in {c.lower() for c in docs.columns}:
            name += "_"
        names.append(name)
    found, pieces = names
    rows = scanned(docs, model, text, (found, pieces))

    def shown(f: Column) -> Column:
        return F.when(f["score"] > cutoff, F.concat(F.left(f["match"], F.length(f["match"]) - F.length(f["value"])), F.lit(mark))).otherwise(f["match"])

    texts = F.concat(F.transform(found, shown), F.array(F.lit("")))
    joined = F.array_join(F.flatten(F.zip_with(pieces, texts, lambda p, r: F.array(p, r))), "")
    any_secret = F.exists(found, lambda f: f["score"] > cutoff)
    return rows.withColumn(text, F.when(any_secret, joined).otherwise(F.col(text))).drop(found, pieces)
