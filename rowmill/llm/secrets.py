"""Secrets in texts: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

from dataclasses import dataclass, field
from math import inf, isqrt, log

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from rowmill.llm.common import written

#: A candidate by itself: a run of at least 16 characters that keys and hashes are written in.
CANDIDATE = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
#: Characters before a candidate in its word that are looked at.
GLUED = 64
#: Words that the dictionary holds: the most frequent ones of all texts.
DICTIONARY_WORDS = 150
TREES, DEPTH, SEED = 20, 6, 11
#: Thresholds of a feature lie at this many quantiles of the findings and of the different values, told apart to 1/GRID.
QUANTILES, GRID = 32, 1000
# Findings of a task when the forest is fitted.
ROWS_PER_TASK = 50_000

# Words that name a secret, and words that name an example.
NAMES = "password passwd pwd passphrase secret token apikey api_key api-key access_key auth bearer credential private".split()
EXAMPLES = "example sample dummy test fake placeholder changeme your xxxx foo".split()

_NAMED = rf"(?i)(?:{'|'.join(NAMES)})[A-Za-z0-9_]*[\"']?\]?"
#: Further candidates: what is assigned to a name of secrets in one word or in the words behind it, six characters on.
ASSIGNED = rf"({_NAMED}(?::|=|:=|=>)[\"']?)([^\s\"',;]{{6,}})"
_ASSIGNED_BEFORE = rf"{_NAMED}(?:[:=]|:=|=>| [:=]| :=| =>)$"
_BARE = r"^[\"'(\[]*([^\s\"']{6,}?)[\"',.;)\]]*$"
#: The password of a connection, between name and host.
IN_URL = r"(://[^\s:/@]*:)([^\s@/]{3,})@"
_ANY = rf"{CANDIDATE}|{_NAMED}\s*[:=]|://[^\s:/@]*:[^\s@/]+@"

FEATURES = [
    "length", "digits", "uppers", "switches", "entropy", "transitions", "covered",
    "named", "glued_length", "assigned", "quoted", "sample_near", "sample_path", "path_depth",
]


def candidates(df: DataFrame, id_column: str, text_column: str, path: Column) -> DataFrame:
    """``(id, path, word_at, nth, value, glued, before, before2, after)``: one row per candidate in each text.

    Candidates are long runs of the characters of keys, values of six characters on that are assigned to a name of
    secrets (``password = "..."``, ``token: a.b.c``), whatever they hold but blanks and quotes, and passwords in
    connection URLs. Where one holds another the longer is taken. ``glued`` are up to ``GLUED`` characters before the
    value in its word, the others are the neighbouring words (empty at the ends). A text is cut into words only if it may
    have a candidate. Null and empty texts have none; a null path is empty.
    """
    rows = df.select(
        F.col(f"`{id_column}`").alias("id"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"),
        F.col(f"`{text_column}`").alias("text"),
    ).where(F.col("text").rlike(_ANY))
    words = rows.select("id", "path", F.split("text", r"\s+").alias("words"))
    word = lambda i: F.coalesce(F.get("words", i), F.lit(""))
    # what may be assigned by the words before it: ``name = value`` and ``name: value``
    behind = lambda before2, before: F.concat_ws(" ", before2, before).rlike(_ASSIGNED_BEFORE)
    near = F.filter(
        F.transform(
            "words",
            lambda w, i: F.struct(
                i.alias("word_at"),
                w.alias("word"),
                word(i - 1).alias("before"),
                word(i - 2).alias("before2"),
                word(i + 1).alias("after"),
            ),
        ),
        lambda x: x["word"].rlike(_ANY) | (x["before"].rlike("[:=]$|=>$") & behind(x["before2"], x["before"])),
    )
    hits = words.select("id", "path", F.explode(near).alias("hit")).select("id", "path", "hit.*")

    def pairs(pattern: str) -> Column:
        """``(glued, value)`` of all matches in the word."""
        group = lambda k: F.regexp_extract_all("word", F.lit(pattern), k)
        return F.zip_with(group(1), group(2), lambda g, v: F.struct(g.alias("glued"), v.alias("value")))

    bare = F.regexp_extract("word", _BARE, 1)
    after_name = F.when(
        behind("before2", "before") & (bare != ""),
        F.array(F.struct(F.call_function("substring_index", F.col("word"), bare, F.lit(1)).alias("glued"), bare.alias("value"))),
    ).otherwise(F.array().cast("array<struct<glued:string,value:string>>"))
    named = F.concat(pairs(ASSIGNED), pairs(IN_URL), after_name)
    hits = hits.withColumns({"named": F.array_distinct(named), "runs": pairs(rf"(\S{{0,{GLUED}}}?)({CANDIDATE})")})
    # a run has sixteen characters at least, so what stands before one is found in the four before it
    run = lambda i: F.concat(F.get("runs", i)["glued"], F.get("runs", i)["value"])
    before = lambda r, i: F.concat_ws("", *(run(i - k) for k in (4, 3, 2, 1)), r["glued"])
    runs = F.transform("runs", lambda r, i: F.struct(before(r, i).alias("glued"), r["value"].alias("value")))
    runs = F.filter(runs, lambda r: ~F.exists("named", lambda n: F.contains(n["value"], r["value"])))
    found = hits.select("*", F.posexplode(F.concat(runs, "named")).alias("nth", "pair"))
    return found.select("id", "path", "word_at", "before", "before2", "after", "nth", "pair.value", F.right("pair.glued", F.lit(GLUED)).alias("glued"))


def measured(found: DataFrame, model: Model | None = None) -> DataFrame:
    """``found`` with the features that need no model, and with ``transitions`` and ``covered`` if one is given."""
    value = F.col("value")
    n = F.length("value").cast("double")
    left = F.lower(F.concat_ws(" ", "before2", "before", "glued"))
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / n
    letters = F.split("value", "")
    each = F.transform(F.array_distinct(letters), lambda c: (n - F.length(F.replace(value, c))) / n)
    out = found.withColumns(
        {
            "length": n,
            "digits": share("[0-9]"),
            "uppers": share("[A-Z]"),
            # changes between digits, capitals, small letters and the rest
            "switches": share("(?<=[0-9])(?=[^0-9])|(?<=[^0-9])(?=[0-9])|(?<=[A-Z])(?=[^A-Z0-9])|(?<=[a-z])(?=[^a-z0-9])"),
            "entropy": -F.aggregate(F.filter(each, lambda p: p > 0), F.lit(0.0), lambda s, p: s + p * F.log2(p)),
            "named": F.lit(left.rlike("|".join(NAMES))).cast("double"),
            "glued_length": F.length("glued").cast("double"),
            "assigned": left.rlike(r"[=:]\s*[\"']?$").cast("double"),
            "quoted": F.col("glued").rlike("[\"']$").cast("double"),
            "sample_near": F.lower(F.concat_ws(" ", "before2", "before", "after")).rlike("|".join(EXAMPLES)).cast("double"),
            "sample_path": F.lower("path").rlike("(^|[/._-])(tests?|examples?|samples?|docs?|fixtures?)([/._-]|$)").cast("double"),
            "path_depth": F.regexp_count("path", F.lit("/")).cast("double"),
        }
    )
    return model.looked_up(out) if model else out


@dataclass
class Model:
    """What is learned: letter pairs and words of the texts; from labelled findings the forest and its thresholds."""

    pairs: dict[str, float]
    words: list[str]
    cuts: dict[str, list[float]] = field(default_factory=dict)
    forest: object | None = None
    constant: float | None = None

    def looked_up(self, found: DataFrame) -> DataFrame:
        """With the mean log probability of the value's character transitions and its share in dictionary words."""
        small = F.lower("value")
        unseen = F.lit(min(self.pairs.values(), default=0.0) - 1.0)
        at = F.sequence(F.lit(1), F.length("value") - 1)
        table = F.create_map(*(F.lit(x) for item in self.pairs.items() for x in item)) if self.pairs else None
        pair = lambda i: F.coalesce(table[F.substr(small, i, F.lit(2))], unseen) if self.pairs else unseen
        total = F.aggregate(F.transform(at, pair), F.lit(0.0), lambda s, x: s + x)
        rest = F.regexp_replace(small, "|".join(self.words), "") if self.words else small
        return found.withColumns(
            {"transitions": total / (F.length("value") - 1), "covered": 1.0 - F.length(rest) / F.length("value")}
        )

    def judged(self, found: DataFrame) -> DataFrame:
        """``found`` with ``probability`` of being a secret; null if nothing was learned."""
        if self.forest is None:
            return found.withColumn("probability", F.lit(self.constant).cast("double"))
        scored = self.forest.transform(self.vectors(found.select("*", *_numbers())))
        return scored.withColumn("probability", vector_to_array("probability")[1]).select(*found.columns, "probability")

    def vectors(self, numbers: DataFrame) -> DataFrame:
        """With the vector of all features, each as the number of its thresholds that it reaches."""
        given, bins = [f"f_{name}" for name in FEATURES], [f"bin_{name}" for name in FEATURES]
        splits = [[-inf, *self.cuts[name], inf] for name in FEATURES]
        binned = Bucketizer(splitsArray=splits, inputCols=given, outputCols=bins).transform(numbers)
        # without the metadata of the Bucketizer, by which trees would take the numbers for unordered categories
        ordered = binned.select(*numbers.columns, *(F.col(name).alias(name, metadata={}) for name in bins))
        return VectorAssembler(inputCols=bins, outputCol="features").transform(ordered)


def _numbers() -> list[Column]:
    return [F.col(name).cast("double").alias(f"f_{name}") for name in FEATURES]


def _words(text: Column, texts: DataFrame) -> DataFrame:
    """``(w, count)``: the words of three letters on in all ``texts``, without candidates and words with digits."""
    near = texts.select(F.explode(F.split(F.lower(text), r"\s+")).alias("near"))
    # no shorter one holds a candidate
    plain = F.when(F.length("near") < 16, F.col("near")).otherwise(F.regexp_replace("near", CANDIDATE, " "))
    counted = near.groupBy(plain.alias("near")).count()
    words = counted.select(F.explode(F.split("near", r"[^\p{L}\p{N}]+")).alias("w"), "count")
    return words.where(F.col("w").rlike(r"^\p{L}{3,}$")).groupBy("w").agg(F.sum("count").alias("count"))


def _cuts(numbers: DataFrame) -> dict[str, list[float]]:
    """Thresholds of every feature over all rows: quantiles of its rows and, for its rare values, of its different values.

    Both are exact to ``1 / GRID``; up to ``QUANTILES`` different values are all told apart.
    """
    value = lambda name: F.floor(F.col(f"f_{name}") * GRID) / GRID
    each = F.array(*(F.struct(F.lit(name).alias("name"), value(name).alias("value")) for name in FEATURES))
    counted = numbers.select(F.explode(each).alias("x")).groupBy("x.name", "x.value").count()
    places = [k / QUANTILES for k in range(QUANTILES + 1)]
    both = F.concat(F.percentile("value", places, F.col("count")), F.percentile("value", places))
    found = counted.groupBy("name").agg(F.array_sort(F.array_distinct(both)).alias("cuts")).collect()
    return {r["name"]: r["cuts"] for r in found}


def fit(labelled: DataFrame, texts: DataFrame | None = None, text_column: str = "text") -> Model:
    """Learn from candidates with a boolean column ``secret``; null labels say nothing.

    Letter pairs and the dictionary are counted over all words of ``texts``, without it over those beside the labelled
    findings. The forest is fitted on every labelled finding, and its thresholds come from all of them; neither their
    order in the table nor its partitions matter. Findings of one kind only give its constant.
    """
    rows = labelled.where("secret is not null")
    if texts is None:
        counted = _words(F.concat_ws(" ", "before2", "before", "after"), rows)
    else:
        counted = _words(F.col(f"`{text_column}`"), texts)
    counted = written(counted, "words")
    words = [r["w"] for r in counted.orderBy(F.desc("count"), "w").limit(DICTIONARY_WORDS).collect()]
    pairs = counted.select(
        F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substr("w", i, F.lit(2)))).alias("pair"), "count"
    ).where(F.col("pair").rlike("^[a-z]{2}$"))  # 676 different ones at most
    seen = {r["pair"]: r["n"] for r in pairs.groupBy("pair").agg(F.sum("count").alias("n")).collect()}
    total = sum(seen.values())
    model = Model({pair: log(n / total) for pair, n in sorted(seen.items())}, sorted(words, key=lambda w: (-len(w), w)))
    place = F.xxhash64("id", "word_at", "nth", "value").alias("place")
    training = measured(rows, model).select(place, *_numbers(), F.col("secret").cast("double").alias("label"))
    training = written(training, "findings")
    kinds = {r["label"]: r["count"] for r in training.groupBy("label").count().collect()}  # two rows at most
    if len(kinds) < 2:
        model.constant = next(iter(kinds), None)
        return model
    n = sum(kinds.values())
    model.cuts = _cuts(training)
    # the rows of each partition and their order decide what each tree draws
    training = training.repartition(max(8, -(-n // ROWS_PER_TASK)), "place")
    training = training.sortWithinPartitions("place", *(f"f_{name}" for name in FEATURES), "label")
    # Spark looks for the values of a feature in a sample of maxBins * maxBins rows (an int): here all
    bins = min(46_340, max(2 * QUANTILES + 3, isqrt(n) + 1))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=bins, seed=SEED, featuresCol="features", labelCol="label"
    )
    model.forest = forest.fit(model.vectors(training))
    return model


def scan(
    df: DataFrame, labelled: DataFrame, path: Column, id_column: str = "doc_id", text_column: str = "text", least: float = 0.5
) -> DataFrame:
    """``(id, word_at, nth, value, probability, secret)`` for every candidate in ``df``.

    ``labelled`` holds findings, candidates (see ``candidates``) with a label ``secret``; a random forest over length,
    character transitions, dictionary coverage, path and neighbouring words learns from them which candidates are false
    positives. Letter transitions and dictionary are those of all texts of ``df``. ``secret`` is whether the probability
    is at least ``least``; without any labelled finding both are null and no candidate is taken away. Repeated rows give
    repeated findings; an empty table gives none.
    """
    found = candidates(df, id_column, text_column, path)
    return judge(found, labelled, least, df, text_column).withColumnRenamed("id", id_column)


def judge(
    found: DataFrame, labelled: DataFrame, least: float = 0.5, texts: DataFrame | None = None, text_column: str = "text"
) -> DataFrame:
    """:func:`scan` for candidates that are there already; ``texts`` are counted as in :func:`fit`."""
    model = fit(labelled, texts, text_column)
    return model.judged(measured(found, model)).select(
        "id", "word_at", "nth", "value", "probability", (F.col("probability") >= least).alias("secret")
    )


#: How known kinds of keys are written, and what is no key (numbers of cards, phones and accounts).
KNOWN_KEYS = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^sk_live_[A-Za-z0-9]{24,}$|^xox[abpr]-[A-Za-z0-9-]{10,}$"
KNOWN_OTHERS = r"^[0-9\-]+$|^[A-Za-z\-]+$"


def labelled_by_rules(found: DataFrame) -> DataFrame:
    """Candidates with ``secret`` where a rule is sure: true for the format of a known key or a random value assigned to
    a name of secrets, false for numbers, for plain words and for values without digits; null elsewhere."""
    left = F.lower(F.concat_ws(" ", "before2", "before", "glued"))
    named = left.rlike(rf"({'|'.join(NAMES)})[\"']?\s*[=:]\s*[\"']?$")
    digits = F.regexp_count("value", F.lit("[0-9]"))
    return found.withColumn(
        "secret",
        F.when(F.col("value").rlike(KNOWN_KEYS), True)
        .when(F.col("value").rlike(KNOWN_OTHERS) | (digits == 0), False)
        .when(named & (digits >= 3), True),
    )
