"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 16 or more characters of keys and encodings with at least
one digit, or a quoted or assigned value of 8 or more characters other than blanks.
A name and its `=` or `:` are no part of the value, `=` at the end is padding; a
value that holds an assignment to a secret's name itself is not taken whole, nor is
an address with a password before its host, whose password is. The forest looks at
its length, how its characters change kind and how evenly they are used, how much of
it the corpus's frequent words cover, the path it was found under, and the words
around it. It is trained from labelled findings, then written out as one native
expression, so that a text is scanned, judged and redacted in a single pass over its
own row, without a shuffle.

Where a corpus has no labelled findings, the forest learns from `labelled_findings`,
which are kept with the package; what a pattern calls a key is only one of its
features, so it can remove what looks like one. The dictionary counts the words
of all texts. The training sample is bounded by TRAINING different vectors of either
label, those of smallest hash, each with the logarithm of its count as its weight, so
repeats take no room and any size of input trains on the same kind of sample.

Defined cases: null, blank and short texts have no findings; a null path is an
empty one; repeated rows have the same findings; null ids are kept. With findings
of one label only there is nothing to learn and the rule (`rule_labels`) decides. An
empty table gives an empty result. Extra columns are ignored by `findings` and
kept by `redact`. Everything is built of native functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.llm import labelled_findings
from ratepanel.llm.frames import cut, fresh

_KEY = r"A-Za-z0-9_+/.\-"
_QUOTE = "[\"'`]"
_NAMES = (
    r"(?i:token|secret|passw(?:or)?d|passphrase|pwd|credential|auth|api[ _-]?key|(?:access|private|signing|client|encryption|account)[ _-]?key)"
)
#: What may follow the name in a longer one: TOKEN_V2, secret_key_base, tokenValue.
_SUFFIX = r"(?:[_-][\w-]{1,24}|[0-9]{1,3}|s|(?-i:[A-Z])\w{0,24})?"
#: Keys that their issuers' forms tell, JSON web tokens, and addresses with a password. Fixed values.
_FORMATS = (
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])|gh[pousr]_[A-Za-z0-9]{30,}|github_pat_\w{22,}|glpat-[\w-]{20,}|"
    r"xox[abeoprs]-[\w-]{10,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|sk-[\w-]{20,}|AIza[\w-]{35}|ya29\.[\w-]{20,}|npm_[A-Za-z0-9]{30,}|"
    r"pypi-[\w-]{30,}|hf_[A-Za-z0-9]{30,}|dop_v1_[0-9a-f]{40,}|shp(?:at|ca|pa|ss)_[0-9a-fA-F]{30,}|SG\.[\w-]{16,}\.[\w-]{16,}|"
    r"eyJ[\w-]{8,}\.eyJ[\w-]{8,}\.[\w-]*)"
)
_AUTHORIZATION = r"(?i:authorization[\"'`]?\s{0,2}[:=]\s{0,2}[\"'`]?(?:bearer|basic|token|apikey)\s)"
_BEARER = rf"(?:{_AUTHORIZATION}|(?i:\bbearer\s))"
_PEM = r"-----BEGIN [A-Z0-9 ]{0,24}PRIVATE KEY(?: BLOCK)?-----"
# Bounds are those of a Java look-behind.
_ASSIGNED = rf"{_QUOTE}?\]?\s{{0,3}}(?::=|=>|==?|:)\s{{0,3}}"
_TO_NAME = rf"{_NAMES}(?i:{_SUFFIX}){_ASSIGNED}"
# An assignment to a secret's name, or a password in an address, within a value that goes on without blanks.
_INNER = rf"(?![^\s\"'`]*?(?:{_NAMES}[\w-]{{0,24}}[=:]|://[^\s/:@]++:[^\s/@]++@))"


def _quoted(mark: str) -> str:
    return rf"(?<=[\s=:(,\[{{>]{mark}|^{mark})(?:(?<={_TO_NAME}{mark})|{_INNER})(?:[^{mark}\s\\]|\\\S){{8,}}+(?={mark})"


# Assigned to a secret's name: anything up to a blank, a quote, the next assignment or a closing mark.
_NAMED = rf"(?<={_TO_NAME})(?!//)(?:[^\s\"'`<>,;&.)\]}}]|[,;&](?![\s\"'`]|\z|[\w ]{{1,40}}=)|[.)\]}}](?![\s\"'`.,;)\]}}]|\z)){{8,}}+"
# Assigned to another name: no assignment within.
_UNNAMED = rf"(?<=[=:]>?\s?)(?!//)[^\s\"'`<>,;&=:(){{}}\[\]]{{8,}}+(?:={{1,2}}(?![{_KEY}\"'`]))?+"
# The body of a private key, lines and all; the password of an address.
_BODY = rf"(?<=-----)(?<={_PEM})(?:[^-]++|-(?!----))++(?=-----END )"
_PASSWORD = r"(?<=:)(?<=://[^\s/:@\"'`]{1,64}:)[^\s/@\"'`]++(?=@)"
_CREDENTIAL = rf"(?<={_BEARER})(?:(?<={_AUTHORIZATION})|(?=[{_KEY}]*[0-9]))[{_KEY}]{{8,}}+={{0,2}}+"
# Anywhere: a run of key characters.
_RUN = rf"(?<![{_KEY}])(?=[A-Za-z_+/.-]*[0-9]|(?:AKIA|ASIA)[A-Z]{{16}})[{_KEY}]{{16,}}+(?:={{1,2}}(?![={_KEY}\"'`]))?+"
# A character or two before the place decide which of the longer looks are taken.
CANDIDATE = (
    rf"(?<=[=:>\"'`-])(?:{'|'.join((_BODY, _PASSWORD, *map(_quoted, "\"'`"), _NAMED, _UNNAMED))})"
    rf"|(?<=[=:>\"'`]\s)(?:{_NAMED}|{_UNNAMED})|(?<=[=:>\"'`]\s\s)(?:{_NAMED})|(?<=[=:>\"'`]\s\s\s)(?:{_NAMED})"
    rf"|(?<=(?i:arer|asic|oken|ikey)\s)(?:{_CREDENTIAL})|{_RUN}"
)
#: Different vectors of training findings of either label at most.
TRAINING = 4000
TREES, DEPTH = 21, 6
#: Words of the dictionary, and their least letters.
DICTIONARY, LETTERS = 200, 4
#: Characters on either side in which neighbouring words are sought.
AROUND = 64
MASK = "<SECRET>"
#: Words by which a value tells that it stands for another.
_SAMPLE = r"(?i)(?:^|[-_. <{\[])(?:your|my|example|sample|dummy|test|fake|placeholder|change-?me|insert|enter|redacted|todo|xxx+)(?:$|[-_. >}\]0-9])"
#: Cuts a text around its candidates; a text that holds it is cut by two passes.
_CUT = "\x01\x02\x01"
_OTHERS = r"(?i)(sha[0-9]*|md5|checksum|commit|digest|hash|uuid|phone|tel|card|iban|order|invoice|version|mail|http)"
#: A digest's kind before a name: what follows is the digest of a secret.
_HASHED = r"(?i)(?:sha[0-9]*|md5|checksum|digest|hash)[ _-]{1,2}\w{1,12}"

FEATURES = (
    "length",
    "switches",
    "digits",
    "uppers",
    "entropy",
    "dictionary",
    "dots",
    "slashes",
    "assigned",
    "quoted",
    "named",
    "named_nearby",
    "other",
    "closed",
    "path_depth",
    "path_test",
    "others",
    "format",
    "bearer",
    "code",
    "sample",
    "repeats",
)


@dataclass(frozen=True)
class Scanner:
    """A dictionary and a forest: nested (feature, threshold, low, high) or votes."""

    words: tuple[str, ...]
    trees: tuple = ()


def dictionary(docs: DataFrame, text: str = "text", most: int = DICTIONARY) -> tuple[str, ...]:
    """The most frequent words of plain letters in all texts."""
    # Words are cut out and lowered before they are counted; only counts are shuffled.
    words = F.explode(F.split(F.lower(F.col(f"`{text}`").cast("string")), r"[^a-z]+")).alias("word")
    counted = docs.select(words).where(F.length("word") >= LETTERS).groupBy("word").count()
    # The report is a top-k of fixed size.
    return tuple(r.word for r in counted.orderBy(F.desc("count"), "word").limit(most).collect())


def _times(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def _entropy(text: Column) -> Column:
    n = F.length(text).cast("double")

    def bits(c: Column) -> Column:
        share = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -share * F.log2(share)

    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda total, c: total + F.when(c == "", 0.0).otherwise(bits(c)))


def features(value: Column, before: Column, after: Column, path: Column, words: tuple[str, ...]) -> Column:
    """`array<double>` in the order of FEATURES."""
    n = F.length(value).cast("double")
    near, next_ = F.substring(before, -AROUND, AROUND), F.substring(after, 1, AROUND)
    known = "|".join(sorted(words, key=len, reverse=True)) or r"(?!)"
    end = r"\W{0,6}$"
    return F.array(
        n,
        _times(value, r"(?<=[a-z])(?![a-z]|$)|(?<=[A-Z])(?![A-Z]|$)|(?<=[0-9])(?![0-9]|$)") / n,
        _times(value, "[0-9]") / n,
        _times(value, "[A-Z]") / n,
        _entropy(value),
        (n - F.length(F.regexp_replace(F.lower(value), known, ""))) / n,
        _times(value, r"\."),
        _times(value, "/"),
        _flag(F.rlike(near, F.lit(r"(?:[=:]|=>)\s*[\"'`]?$"))),
        _flag(F.rlike(near, F.lit(r"[\"'`]$")) & F.rlike(next_, F.lit(r"^[\"'`]"))),
        _flag(F.rlike(near, F.lit(rf"{_NAMES}(?i:{_SUFFIX}){end}"))),
        _flag(F.rlike(F.concat_ws(" ", near, next_), F.lit(_NAMES))),
        _flag(F.rlike(near, F.lit(_OTHERS + end)) | F.rlike(near, F.lit(_HASHED + end))),
        _flag(F.rlike(next_, F.lit(r"^([\"'`;,)]|\s|$)"))),
        _times(path, "/"),
        _flag(F.rlike(path, F.lit(r"(?i)\b(tests?|examples?|samples?|fixtures?|docs?)\b"))),
        _times(value, r"[^A-Za-z0-9]"),
        _flag(
            F.rlike(value, F.lit(_FORMATS))
            | F.rlike(near, F.lit(rf"{_PEM}$"))
            | (F.rlike(near, F.lit(r"://[^\s/:@\"'`]*:$")) & F.startswith(next_, F.lit("@")))
        ),
        _flag(F.rlike(near, F.lit(rf"{_BEARER}$"))),
        _flag(F.rlike(value, F.lit(r"^[$%<{]|\$\{|^[A-Za-z_][\w.:>-]*[(\[]"))),
        _flag(F.rlike(value, F.lit(_SAMPLE))),
        (n - F.length(F.regexp_replace(value, r"(.)\1{3,}", ""))) / n,
    )


def rule_labels(values: Column) -> Column:
    """1 for a secret, 0 for what is surely none, null for what only looks like one.

    A secret is a value of a known key's form, one after an authorization's kind, or
    a long, uneven value, or a shorter one of mixed characters, assigned to a name
    that speaks of secrets. Unsure is what else stands by such a name, and long,
    uneven values of which nothing near tells another use.
    """
    at = {name: i for i, name in enumerate(FEATURES)}
    get = lambda name: F.get(values, F.lit(at[name]))
    is_ = lambda name: get(name) == 1
    uneven = (get("entropy") > 3) & (get("length") >= 20)
    # Letters, digits and, outside quotes, no call and no path of names.
    mixed = (get("entropy") > 2.5) & (get("digits") > 0) & (get("digits") < 1) & (is_("quoted") | (get("dots") == 0) | (get("switches") > 0.2))
    told = is_("named") & is_("assigned") & (uneven | mixed) & (get("code") == 0)
    key_like = uneven & (get("digits") > 0) & (get("digits") < 1) & (get("dictionary") < 0.3) & (get("dots") == 0) & (get("slashes") == 0)
    unsure = is_("named") | is_("named_nearby") | key_like
    return F.when(is_("format") | is_("bearer") | told, 1).when((get("other") == 0) & unsure, F.lit(None)).otherwise(0)


def _raw(docs: DataFrame, text: str, path: str | None, words: tuple[str, ...], name: str) -> tuple[DataFrame, str]:
    """The documents with `name array<struct<value, features>>`, and with the texts cut into what is between candidates, and these, in turn."""
    plain = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    where = F.coalesce(F.col(f"`{path}`").cast("string"), F.lit("")) if path else F.lit("")
    cuts = fresh(docs, f"{name}_cuts")
    # The pattern runs once over a text.
    once = F.split(F.regexp_replace(plain, CANDIDATE, f"{_CUT}$0{_CUT}"), _CUT, -1)
    values, between = F.regexp_extract_all(plain, F.lit(CANDIDATE), F.lit(0)), F.split(plain, CANDIDATE, -1)
    twice = F.slice(F.flatten(F.zip_with(between, values, lambda b, v: F.array(b, v))), F.lit(1), 2 * F.size(between) - 1)
    # Of use to no row, the running number keeps the optimizer from running the pattern again in filters of its own.
    found = docs.withColumn(cuts, F.when(F.monotonically_increasing_id() >= 0, F.when(F.contains(plain, F.lit(_CUT)), twice).otherwise(once)))
    part = lambda i: F.coalesce(F.get(F.col(cuts), i), F.lit(""))
    places = F.expr(f"IF(size(`{cuts}`) > 1, sequence(1, size(`{cuts}`) - 2, 2), CAST(array() AS ARRAY<INT>))")
    judged = F.transform(
        places,
        # The name of a value may be a candidate too.
        lambda i: F.struct(part(i).alias("value"), features(part(i), F.concat(part(i - 2), part(i - 1)), part(i + 1), where, words).alias("features")),
    )
    return found.withColumn(name, judged), cuts


def candidates(docs: DataFrame, words: tuple[str, ...], id_column: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """`id, number, value, features` of every candidate; numbers count from 0 within a text."""
    columns = [F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text")]
    narrow = docs.select(*columns, *([F.col(f"`{path}`").alias("path")] if path else []))
    found, _ = _raw(narrow, "text", "path" if path else None, words, "found")
    # The outer form infers no filter, which would judge all candidates twice.
    told = found.select("id", F.posexplode_outer("found").alias("number", "c")).where("c IS NOT NULL")
    return told.select("id", "number", "c.*")


def _parse_tree(text: str):
    """The nested form of one tree of Spark's printed forest."""
    lines = [line.strip() for line in text.strip().splitlines()]
    at = 0

    def node():
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict:"):
            return float(line.split()[1])
        feature, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = node()
        at += 1  # its Else
        return int(feature), float(threshold), low, node()

    return node()


def train(labelled: DataFrame, words: tuple[str, ...], most: int = TRAINING, seed: int = 7) -> Scanner:
    """A scanner from `features array<double>, label` rows; of either label at most `most` different vectors are used, each weighed by how often it is there."""
    known = labelled.where(F.col("label").isin(0, 1)).groupBy("features", F.col("label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    mixed = F.xxhash64("features")
    picked = [known.where(F.col("label") == k).orderBy(mixed, "features").limit(most) for k in (0, 1)]
    sample = cut(picked[0].union(picked[1]))
    if sample.select("label").distinct().count() < 2:
        return Scanner(words)
    rows = sample.select(array_to_vector("features").alias("v"), F.col("label").cast("double").alias("label"), F.log2(F.col("n") + 1).alias("weight"))
    # A vector stands for all its repeats, so no tree goes without it; trees differ by the features they may look at.
    forest = RandomForestClassifier(
        featuresCol="v",
        labelCol="label",
        weightCol="weight",
        numTrees=TREES,
        maxDepth=DEPTH,
        seed=seed,
        featureSubsetStrategy="onethird",
        bootstrap=False,
    )
    fitted = forest.fit(rows)
    printed = re.split(r"\n\s*Tree \d+ \(weight [^)]*\):\n", fitted.toDebugString)[1:]
    return Scanner(words, tuple(_parse_tree(t) for t in printed))


def _vote(values: Column, tree) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, threshold, low, high = tree
    return F.when(F.get(values, F.lit(feature)) <= threshold, _vote(values, low)).otherwise(_vote(values, high))


def score(values: Column, scanner: Scanner) -> Column:
    """Share of the trees that call a finding a secret; the rule's word without trees."""
    if not scanner.trees:
        return F.coalesce(rule_labels(values), F.lit(0)).cast("double")
    total = _vote(values, scanner.trees[0])
    for tree in scanner.trees[1:]:
        total = total + _vote(values, tree)
    return total / len(scanner.trees)


def packaged(spark: SparkSession, words: tuple[str, ...], held: bool = False) -> DataFrame:
    """`id, features, label` of the labelled findings that are kept with the package; features are null where the pattern finds nothing.

    The list is of fixed size.
    """
    rows = [(n, before + value + after, path, value, label) for n, before, value, after, path, label in labelled_findings.findings(held)]
    texts = spark.createDataFrame(rows, "id long, text string, path string, said string, label int")
    found = candidates(texts, words, "id", "text", "path")
    own = texts.select(F.col("id").alias("of"), "said", "label")
    return own.join(found, (own.of == found.id) & (own.said == found.value), "left").select(F.col("of").alias("id"), "features", "label")


def fit(docs: DataFrame, labelled: DataFrame | None = None, id_column: str = "doc_id", text: str = "text", path: str | None = None) -> Scanner:
    """A scanner for a corpus.

    `labelled` has `id, number, label` of findings; findings it does not name are
    not learned from. Without it the package's own findings are learned from, and
    the corpus is read for its dictionary only.
    """
    words = dictionary(docs, text)
    if labelled is None:
        return train(packaged(docs.sparkSession, words).where("features IS NOT NULL"), words)
    found = candidates(docs, words, id_column, text, path)
    return train(found.join(labelled.select("id", "number", "label"), ["id", "number"]).select("features", "label"), words)


def findings(docs: DataFrame, scanner: Scanner, id_column: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Every candidate with its digest, length, score and verdict; the value itself is not told."""
    found = candidates(docs, scanner.words, id_column, text, path)
    scored = found.select("*", score(F.col("features"), scanner).alias("score"))
    return scored.select(
        F.col("id").alias(id_column),
        "number",
        F.sha2("value", 256).alias("value_sha256"),
        F.length("value").alias("length"),
        "score",
        (F.col("score") >= 0.5).alias("is_secret"),
    )


def redact(docs: DataFrame, scanner: Scanner, text: str = "text", path: str | None = None) -> DataFrame:
    """The documents with each secret replaced by MASK; other columns and texts as they are."""
    name = fresh(docs, "found")
    found, cuts = _raw(docs, text, path, scanner.words, name)
    # Every second part is a candidate.
    judged = F.transform(F.col(name), lambda c: F.when(score(c["features"], scanner) >= 0.5, F.lit(MASK)).otherwise(c["value"]))
    said = fresh(found, f"{name}_said")
    told = found.withColumn(said, judged)
    joined = F.array_join(F.transform(F.col(cuts), lambda t, i: F.when(i % 2 == 0, t).otherwise(F.get(F.col(said), (i / 2).cast("int")))), "")
    return told.withColumn(text, F.when(F.size(cuts) > 1, joined).otherwise(F.col(f"`{text}`"))).drop(name, cuts, said)
