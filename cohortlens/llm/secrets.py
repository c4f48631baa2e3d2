"""Secret scans: candidates by shape, false positives removed by a random forest."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stored, text_or_empty

MIN_LENGTH = 12
TREES, DEPTH = 20, 6
CUT = 0.5
#: Bound of the labelled findings the forest is trained on.
SAMPLE_ROWS = 20_000
#: Words of the dictionary: the most common of the whole corpus.
DICTIONARY_WORDS = 5_000
NEIGHBOUR_BUCKETS = 16
MASK = "[SECRET]"
#: Shapes whose label is sure, by which findings are labelled when no labels are given.
KEY_WORDS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "auth")
SURE_SHAPES = r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{24,}|xox[baprs]-[A-Za-z0-9-]{10,}"
SURE_SECRET = f"^({SURE_SHAPES})$"
SURE_HARMLESS = (r"^[^@\s]+@[^@\s]+\.[a-z]+[.,]?$|^(https?|ftp)://(?!\S*[?&;][^=\s]*=)(?![^/\s]*@)|^[0-9.,:+()/-]+$"
                 r"|^\p{Lu}?[\p{Ll}.,;:!?'-]+$|^[\p{Lu}.,;:!?'-]{1,15}$")
#: Names that hold a key word, up to their end or a part set off by a line; what follows is their value.
_NAME = r"[\p{L}\p{N}_.-]*?(?:" + "|".join(w.replace("_", "[_-]?") for w in KEY_WORDS) + r")s?(?:[_-][\p{L}\p{N}_-]*)?"
_SIGN = r"[\"']?[=:]+>?[\"']*"
NAMED_VALUE = rf"(?i)({_NAME}){_SIGN}([^\s\"'=:]\S*)$"
NAME_BEFORE = rf"(?i)(?<![\p{{L}}\p{{N}}]){_NAME}{_SIGN}$"
NAME_ALONE = rf"(?i)^[\"'(\[{{]*{_NAME}[\"']?$"
SIGN_ALONE = r"^[=:]+>?$"
USER_PART = r"://[^/@\s:]*:([^/@\s]+@\S*)$"
#: Shapes of many kinds of characters: three kinds of lower, upper, digit and mark, long runs of capitals and digits, repeated changes of case.
VARIED = (r"^(?=\S{8})(?:(?=.*\p{Ll})(?=.*\p{Lu})(?=.*[0-9!@#$%^&*+=_~]\S)|(?=.*\p{L})(?=.*[0-9])(?=.*[!@#$%^&*+=_~]))"
          r"|[A-Z0-9]{16}|^(?=\S{12})\S*\p{Ll}\p{Lu}\S*\p{Ll}\p{Lu}")
#: Values given to a name that are sure: letters with digits or marks, and for passwords and secrets also letters alone behind an equals sign.
_SURE_VALUE = r"^(?=[^&@]*\p{L})(?=[^&@]*[0-9!#$%^*+~])[^\s(){}<>\[\]/&]{6,}(?:[&@]\S*)?$"
_SURE_LETTERS = r"^(?!(?i:none|null|true|false|string|required|optional|undefined|default|example|changeme)$)\p{L}{6,}$"


def _named() -> Column:
    """Whether a finding is the value of a name with a key word, in its own token or by the tokens before it."""
    return (F.col("token").rlike(NAMED_VALUE) | F.col("token").rlike(USER_PART) | F.col("before").rlike(NAME_BEFORE)
            | (F.col("before").rlike(SIGN_ALONE) & F.col("ahead").rlike(NAME_ALONE)))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, token_no, token, before, ahead, after): tokens of a candidate's shape and their neighbours.

    A candidate has at least MIN_LENGTH characters, two digits among them, or a
    sure or varied shape, or is the value of a name that holds a key word,
    whatever its length and characters, or a token with anything but letters
    right behind such a name.
    """
    tokens = F.split(text_or_empty(), r"\s+")

    def at(i: Column) -> Column:
        return F.when((i >= 0) & (i < F.size("tokens")), F.get("tokens", i)).otherwise("")

    def wanted(i: Column) -> Column:
        token, before = F.col("tokens")[i], at(i - 1)
        value = token.rlike(r"[\p{L}\p{N}]") | (F.length(token) >= 6)
        return (((F.length(token) >= MIN_LENGTH) & token.rlike("[0-9][^0-9]*[0-9]"))
                | ((F.length(token) >= 8) & (token.rlike(VARIED) | token.rlike(SURE_SHAPES)))
                | token.rlike(NAMED_VALUE) | token.rlike(USER_PART)
                | (value & before.rlike(NAME_BEFORE))
                | (value & before.rlike(SIGN_ALONE) & at(i - 2).rlike(NAME_ALONE))
                | (token.rlike(r"[^\p{L}.,;:!?'\"()-]") & value & before.rlike(NAME_ALONE)))

    place = F.filter(F.sequence(F.lit(0), F.size("tokens") - 1), wanted)
    return (docs.select("doc_id", tokens.alias("tokens")).select("doc_id", "tokens", F.explode(place).alias("token_no"))
            .select("doc_id", "token_no", at(F.col("token_no")).alias("token"), at(F.col("token_no") - 1).alias("before"),
                    at(F.col("token_no") - 2).alias("ahead"), at(F.col("token_no") + 1).alias("after")))


def _described(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The findings with key word, secret body and the columns of FEATURES."""
    bound = F.col("before").rlike("^[=:]+$")
    own = F.regexp_extract("token", r"^([\p{L}_-]+)[=:]", 1)
    user, name = F.regexp_extract("token", USER_PART, 1), F.regexp_extract("token", NAMED_VALUE, 1)
    key = F.lower(F.when(user != "", "password").when(name != "", name).when(own != "", own).when(bound, F.col("ahead"))
                  .otherwise(F.col("before")))
    # a value in a token ends with it, so that further ones behind it go as well
    value = (F.when(user != "", user).when(name != "", F.regexp_extract("token", NAMED_VALUE, 2))
             .otherwise(F.regexp_replace("token", r"^[\p{L}_-]+[=:]", "")))
    body = F.regexp_replace(value, r"^[\"'(<\[{]+|[\"')>\]},;.!?*&%$#]+$", "")
    rows = found.withColumn("key_word", F.regexp_replace(key, r"[^\p{L}_]", "")).withColumn("secret", body)
    size = F.greatest(F.length("secret"), F.lit(1))
    share = lambda pattern: F.regexp_count("secret", F.lit(pattern)) / size
    rows = (rows.withColumn("f_length", F.length("secret").cast("double"))
            .withColumn("f_digits", share("[0-9]")).withColumn("f_upper", share(r"\p{Lu}")).withColumn("f_lower", share(r"\p{Ll}"))
            .withColumn("f_hex", share("[0-9a-f]"))
            .withColumn("f_turns", share(r"(?<=[0-9])(?=\p{L})|(?<=\p{L})(?=[0-9])|(?<=\p{Ll})(?=\p{Lu})"))
            .withColumn("f_vowels", share("[aeiouAEIOU]"))
            .withColumn("f_kinds", F.size(F.array_distinct(F.split("secret", ""))) / size)
            .withColumn("f_path", F.regexp_count("token", F.lit(r"[/\\@:.]")).cast("double"))
            .withColumn("f_bound", (bound | (own != "")).cast("double"))
            .withColumn("f_named", _named().cast("double")))
    for side, word in (("before", F.col("key_word")), ("after", F.lower("after"))):
        bucket = F.pmod(F.xxhash64(word), F.lit(NEIGHBOUR_BUCKETS))
        for k in range(NEIGHBOUR_BUCKETS):
            rows = rows.withColumn(f"f_{side}_{k}", (bucket == k).cast("double"))
    # dictionary coverage: letters in runs that are words of the corpus
    runs = (rows.select("doc_id", "token_no", F.explode(F.regexp_extract_all(F.lower("secret"), F.lit(r"(\p{L}{3,})"))).alias("word"))
            .join(dictionary, "word").groupBy("doc_id", "token_no").agg(F.sum(F.length("word")).alias("covered")))
    return rows.join(runs, ["doc_id", "token_no"], "left").withColumn("f_words", F.coalesce("covered", F.lit(0)) / size).drop("covered")


FEATURES = (["f_length", "f_digits", "f_upper", "f_lower", "f_hex", "f_turns", "f_vowels", "f_kinds", "f_path", "f_bound", "f_named", "f_words"]
            + [f"f_{side}_{k}" for side in ("before", "after") for k in range(NEIGHBOUR_BUCKETS)])


def dictionary_of(docs: DataFrame, words: int = DICTIONARY_WORDS) -> DataFrame:
    """The most common words of three letters or more, counted over all texts."""
    counted = (docs.select(F.explode(F.split(F.lower(text_or_empty()), r"[^\p{L}]+")).alias("word"))
               .where(F.length("word") >= 3).groupBy("word").count())
    return counted.orderBy(F.desc("count"), "word").limit(words).select("word")


def label_rule() -> Column:
    """1 for sure secrets, 0 for sure false positives, null for all else."""
    keyed = F.col("key_word").isin(*KEY_WORDS) & F.col("secret").rlike("^[0-9a-fA-F]{16,}$")
    equals = F.coalesce(F.col("token").contains("=") | F.col("before").contains("="), F.lit(False))
    letters = F.col("key_word").rlike("(password|passwd|pwd|secret)$") & equals & F.col("secret").rlike(_SURE_LETTERS)
    named = (F.col("f_named") == 1) & (F.col("secret").rlike(_SURE_VALUE) | letters)
    return (F.when(F.col("secret").rlike(SURE_SECRET) | keyed | named, 1.0)
            .when(F.col("token").rlike(SURE_HARMLESS) & (F.col("f_named") == 0), 0.0))


def findings(docs: DataFrame, labels: DataFrame | None = None, cut: float = CUT) -> DataFrame:
    """(doc_id, token_no, secret, key_word, probability, is_secret) of every candidate of every text.

    ``labels`` (doc_id, token_no, label) are findings someone has judged; without
    them, shapes whose label is sure are the training set. A bounded sample of it
    trains a forest on length, character transitions, dictionary coverage, path
    marks and neighbouring words, which then judges all candidates of unsure
    shape; sure secrets stay secrets. With labels of one kind only, that kind is the answer
    for labelled findings and no other finding is a secret.

    Null and empty texts have no candidate. Repeated rows of one doc_id give one
    finding per place. An empty table gives an empty result; other columns are
    ignored. Tokens are what stands between white space, counted from 0.
    """
    docs = docs.select("doc_id", "text")
    dictionary = stored(dictionary_of(docs), "secret-words")
    found = stored(candidates(docs).dropDuplicates(["doc_id", "token_no"]), "secret-candidates")
    rows = stored(_described(found, dictionary), "secret-features")
    if labels is None:
        known = rows.withColumn("label", label_rule()).where(F.col("label").isNotNull())
    else:
        known = rows.join(labels.select("doc_id", "token_no", F.col("label").cast("double").alias("label")), ["doc_id", "token_no"])
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    keep = ["doc_id", "token_no", "secret", "key_word"]
    sure = F.when(label_rule() == 1, 1.0) if labels is None else F.lit(None).cast("double")
    if len(counts) < 2:
        judged = known.select("doc_id", "token_no", F.col("label").alias("probability"))
        out = rows.select(*keep).join(judged, ["doc_id", "token_no"], "left").withColumn("probability", F.coalesce("probability", F.lit(0.0)))
    else:
        draw = F.pmod(F.xxhash64("doc_id", "token_no", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
        rate = reduce(lambda c, x: F.when(F.col("label") == x[0], min(1.0, SAMPLE_ROWS / 2 / x[1])).otherwise(c), counts.items(), F.lit(0.0))
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=17, featureSubsetStrategy="sqrt", subsamplingRate=0.8)
        train = stored(known.where(draw < rate).select("label", *FEATURES).orderBy(*FEATURES, "label"), "secret-labelled")
        model = forest.fit(vectors.transform(train))
        out = (model.transform(vectors.transform(rows.select(*keep, sure.alias("sure"), *FEATURES)))
               .select(*keep, F.coalesce("sure", vector_to_array("probability")[1]).alias("probability")))
    return out.withColumn("is_secret", F.col("probability") >= cut)


def redact(docs: DataFrame, labels: DataFrame | None = None, cut: float = CUT, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mask``; no document is dropped.

    ``n_chars``, where there is one, follows a changed text; other columns and
    null texts stay as they are.
    """
    sure = findings(docs, labels, cut).where(F.col("is_secret") & (F.col("secret") != ""))
    plain = ~((F.length("secret") >= MIN_LENGTH) & F.col("secret").rlike("[0-9][^0-9]*[0-9]"))
    secrets = stored(sure.groupBy(F.col("doc_id").alias("found_in")).agg(
        F.collect_set(F.when(~plain, F.col("secret"))).alias("taken"),
        F.map_from_entries(F.collect_list(F.when(plain, F.struct("token_no", "secret")))).alias("placed")), "secret-texts")
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(secrets.hint("merge"), F.col("row.doc_id") == F.col("found_in"), "left")
    # what may be a common word is masked in its own token only, all else wherever it stands; a piece is a token with the space behind it
    pieces = F.transform(F.split("row.text", r"(?<=\s)(?=\S)"),
                         lambda p, i: F.when(F.try_element_at("placed", i).isNull(), p)
                         .otherwise(F.replace(p, F.try_element_at("placed", i), F.lit(mask))))
    own = F.when(F.size("placed") == 0, F.col("row.text")).otherwise(F.array_join(pieces, ""))
    longest_first = F.reverse(F.array_sort(F.transform("taken", lambda s: F.struct(F.length(s).alias("n"), s.alias("s")))))
    text = F.when(F.col("taken").isNull(), F.col("row.text")).otherwise(
        F.aggregate(longest_first, own, lambda t, s: F.replace(t, s["s"], F.lit(mask))))
    return joined.select(*[
        text.alias(c) if c == "text" else
        F.when(F.col("taken").isNull(), F.col("row.n_chars")).otherwise(F.length(text)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
        F.col(f"row.`{c}`").alias(c) for c in docs.columns])
