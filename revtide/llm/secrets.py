"""Secret scans: candidates by shape, false positives removed by a random forest.

A word of 10 characters or more that holds a letter gives candidates if it has a digit, or a
secret's name in itself or right before: what follows `name=` or `name:` at its start (8
characters or more), else its first plain run (12 or more); and of each piece between
delimiters what follows a name (quoted names and URL parameters too), and every plain run. A
candidate itself has a digit or a secret's name to it. A random forest judges it by
length, character transitions, dictionary coverage, the path it comes from and the words
around it. The forest is Spark's, trained on a bounded sample of labelled findings of each kind; its
trees become one SQL expression, so scanning, scoring and redaction are a single pass over
each text, in DataFrame functions only.

No table of labelled findings is given, so labels come from what settles a finding: issuers'
formats, names that a value is directly given to, addresses, versions, bare digests. None of
these facts is a feature. Which neighbouring words count is learned from the sample, not
stated. `held_out_quality` tells precision and recall on values that took no part in training.

Null and empty texts have no findings. A value that occurs twice in a text is two
findings. Null paths are paths without a sign. Without labelled findings of both kinds
every finding scores as the one kind that there is, and as a secret if there is none.
Only doc_id, text and the path column are read; redaction keeps all columns.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.base import SPACES, native_words, smallest_hashes, stored, unused_name

#: Findings the forest is trained on, and its size.
SAMPLE_FINDINGS, TREES, DEPTH, THRESHOLD = 5_000, 24, 5, 0.5
#: How many words and letter pairs of all texts the dictionary keeps; how many neighbouring words count.
WORDS, PAIRS, NEAR = 4_000, 150, 16
REDACTED = "[SECRET]"
WORD = r"[^\x20\x09-\x0D]+"

NAMED = r"^[^A-Za-z0-9]*[A-Za-z][A-Za-z0-9_.-]*(?:=|:)+[\"']?([^\"',;]{8,})"
PLAIN = r"[A-Za-z0-9+/_.~-]{12,}={0,2}"
#: A piece of a word: a name with its sign, if any, and what runs up to the next delimiter.
NAME = r"(?<![A-Za-z0-9_.-])[_.-]*+[A-Za-z][A-Za-z0-9_.-]*+(?:\\?[\"'])?[=:]++(?:\\?[\"'])?"
BODY = r"[!#-%*+\-./0-9@A-Z^_a-z~]{8,}={0,2}"
#: The host of a mail address is no candidate of its own beside what comes before it.
HOST = r"@[a-z0-9-]++(?:\.[a-z0-9-]+)*\.[a-z]{2,}(?![A-Za-z0-9+/_~-])"
PIECE, NAMED_PIECE = f"(?:{NAME})?{BODY}", f"^{NAME}({BODY})$"
SECRET_WORDS = "pass(word|wd|phrase)?|pwd|secret|token|api.?key|access.?key|private|credential|auth|bearer|client.?id"
#: A whole word, or the name in `name=value`, that says its value is secret.
SECRET_NAME = r"(?i)(?:^|[^A-Za-z])(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|credentials?)[^A-Za-z]*$"
HARMLESS_PATHS = "test|example|sample|docs?/|fixture|mock"
#: What the labels of the training findings go by. Published key formats.
ISSUED = (r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-|^AIza[0-9A-Za-z_-]{35}$"
          r"|^sk_live_|^eyJ[A-Za-z0-9_-]+\.eyJ|^glpat-|^npm_[A-Za-z0-9]{36}$")


#: A value that may be given to a secret's name.
NAMED_PLAIN = r"^[A-Za-z0-9+/_~-]{12,}={0,2}$"


# --- findings -------------------------------------------------------------

KIND = "array<struct<value:string,named:boolean,before:string,word:string>>"


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def by_word(text: Column, path: Column) -> Column:
    """Per word its candidates as an array of (at, value, named, before, after, path, word), or null.

    `at` counts the words before; `word` is the piece that the value is in, or the whole word.
    """
    def near(words: Column, i: Column, steps: range) -> Column:
        return F.lower(F.concat_ws(" ", *[F.get(words, i + k) for k in steps]))

    def found(value: Column, named: Column, before: Column, word: Column) -> Column:
        return F.struct(F.rtrim(value, F.lit("\"'.)")).alias("value"), named.alias("named"),
                        F.lower(F.coalesce(before, F.lit(""))).alias("before"), word.alias("word"))

    def of_piece(pieces: Column, piece: Column, j: Column) -> Column:
        """What is named in a piece, and its plain runs; a run without a name has the piece before it."""
        def values(body: Column) -> Column:
            name = F.regexp_extract(piece, r"^(.*?)[=:]", 1)
            before = F.when(name != "", name).when(j > 0, F.get(pieces, j - 1))
            named = F.when(body != "", F.array(found(body, F.lit(True), before, piece)))
            runs = F.filter(F.regexp_extract_all(F.regexp_replace(piece, HOST, "@"), F.lit(PLAIN), F.lit(0)), lambda r: r != body)
            return F.concat(F.coalesce(named, F.array().cast(KIND)), F.transform(runs, lambda r: found(r, F.lit(False), before, piece)))

        return _let(F.regexp_extract(piece, NAMED_PIECE, 1), values)

    def of_word(word: Column) -> Column:
        def with_whole(inner: Column) -> Column:
            named = F.regexp_extract(word, NAMED, 1)
            value = F.when(named != "", named).otherwise(F.regexp_extract(word, PLAIN, 0))
            whole = found(value, named != "", F.regexp_extract(word, r"^(.*?)[=:]", 1), word)
            return _let(whole, lambda x: F.when(F.exists(inner, lambda y: y["value"] == x["value"]), inner).otherwise(F.concat(F.array(x), inner)))

        pieces = F.regexp_extract_all(word, F.lit(PIECE), F.lit(0))
        return _let(_let(pieces, lambda p: F.flatten(F.transform(p, lambda piece, j: of_piece(p, piece, j)))), with_whole)

    def one(words: Column, word: Column, i: Column) -> Column:
        before = F.coalesce(F.get(words, i - 1), F.lit(""))
        named = before.rlike(SECRET_NAME)
        digit = word.rlike("[0-9]")
        shaped = (F.length(word) >= 10) & word.rlike("[A-Za-z]") & (digit | named | word.rlike("[=:]"))
        kept = lambda x: x["value"].rlike("[0-9]") | named | x["before"].rlike(SECRET_NAME)
        return F.when(shaped, F.transform(F.filter(of_word(word), lambda x: (F.length(x["value"]) >= 8) & kept(x)), lambda x: F.struct(
            i.alias("at"), x["value"].alias("value"), x["named"].alias("named"),
            F.concat_ws(" ", near(words, i, range(-3, 0)), x["before"]).alias("before"),
            near(words, i, range(1, 2)).alias("after"), F.lower(F.coalesce(path, F.lit(""))).alias("path"), x["word"].alias("word"))))

    return _let(native_words(text), lambda w: F.transform(w, lambda x, i: one(w, x, i)))


def _flat(per_word: Column) -> Column:
    return F.flatten(F.filter(per_word, lambda f: f.isNotNull()))


def candidates(text: Column, path: Column) -> Column:
    """All candidates of a text in one array."""
    return _flat(by_word(text, path))


# --- features -------------------------------------------------------------

@dataclass(frozen=True)
class Language:
    """Frequent words and letter pairs of the texts, and the neighbouring words that tell findings apart."""

    words: tuple[str, ...]
    pairs: tuple[str, ...]
    near: tuple[str, ...] = ()


def language(docs: DataFrame) -> Language:
    """From the word counts of all texts."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    counted = stored(words.groupBy("word").count(), "language")
    pairs = counted.select("count", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(2)))).alias("pair"))
    pairs = pairs.groupBy("pair").agg(F.sum("count").alias("count"))

    def top(rows: DataFrame, name: str, n: int) -> tuple[str, ...]:
        return tuple(r[0] for r in rows.orderBy(F.desc("count"), name).limit(n).select(name).collect())

    return Language(top(counted, "word", WORDS), top(pairs, "pair", PAIRS))


def features(x: Column, known: Language) -> dict[str, Column]:
    """The numbers that the forest sees of a finding."""
    value, size = x["value"], F.length(x["value"])

    def share(part: Column) -> Column:
        return part / F.greatest(size, F.lit(1))

    def count(pattern: str) -> Column:
        return size - F.length(F.regexp_replace(value, pattern, ""))

    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9")
    pieces = F.regexp_extract_all(F.lower(F.regexp_replace(value, "([a-z])([A-Z])", "$1 $2")), F.lit("[a-z]{3,}"), F.lit(0))
    covered = F.aggregate(F.filter(pieces, lambda p: p.isin(*known.words)) if known.words else F.array().cast("array<string>"),
                          F.lit(0), lambda n, p: n + F.length(p))
    letters = F.lower(value)
    pairs = F.filter(F.transform(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), lambda i: F.substr(letters, i, F.lit(2))),
                     lambda p: p.isin(*(known.pairs or ("  ",))))
    return {
        "length": size.cast("double"),
        "changes": share(F.length(F.regexp_replace(classes, r"(.)\1*", "x")) - 1),
        "usual_pairs": share(F.size(pairs)), "dictionary": share(covered),
        "digits": share(count("[0-9]")), "capitals": share(count("[A-Z]")), "signs": share(count("[^A-Za-z0-9]")),
        "different": share(F.size(F.array_distinct(F.split(value, "")))),
        "harmless_path": x["path"].rlike(HARMLESS_PATHS).cast("double"),
        **neighbours(x["before"], x["after"], known.near),
    }


def neighbours(before: Column, after: Column, near: tuple[str, ...]) -> dict[str, Column]:
    """Which of the words that count stand before or after."""
    around = F.concat(F.lit(" "), F.regexp_replace(F.concat_ws(" ", before, after), "[^a-z]+", " "), F.lit(" "))
    return {f"near{i}": around.contains(f" {near[i]} ").cast("double") if i < len(near) else F.lit(0.0) for i in range(NEAR)}


NAMES = ["length", "changes", "usual_pairs", "dictionary", "digits", "capitals", "signs", "different", "harmless_path",
         *[f"near{i}" for i in range(NEAR)]]


def findings(known: Language, path: str = "source") -> Column:
    """Per word an array of findings with their features, or null."""
    def with_features(x: Column) -> Column:
        return F.struct(*[x[c].alias(c) for c in ("at", "value", "named", "before", "after", "path", "word")],
                        F.struct(*[c.alias(n) for n, c in features(x, known).items()]).alias("f"))

    return F.transform(by_word(F.col("text"), F.col(path)), lambda found: F.transform(found, with_features))


# --- labels and the forest ------------------------------------------------

def labelled(found: DataFrame) -> DataFrame:
    """Findings whose kind their form settles, with `label`; the others are left out.

    Secrets: keys in an issuer's format, and values of plain characters that a secret's
    name is given to or stands right before. Harmless: addresses, versions, dates,
    placeholders, and digests of the usual lengths without a secret's name near them.
    """
    value, before = F.col("value"), F.col("before")
    digest = value.rlike("^([0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64})$") & ~before.rlike(SECRET_WORDS)
    harmless = (F.col("word").rlike(r"@|://|(?i)example|changeme|placeholder|x{4,}|\*{3,}") & ~value.rlike(ISSUED)) | value.rlike(
        r"^v?[0-9]+([._-][0-9A-Za-z]{1,4})+$|\.(com|net|org|html?|js|py|png|jpe?g|pdf)$|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-") | digest
    plain = value.rlike(NAMED_PLAIN)
    secret = value.rlike(ISSUED) | (plain & value.rlike("[0-9]") & before.rlike(SECRET_WORDS)) | (plain & before.rlike(SECRET_NAME))
    return found.withColumn("label", F.when(harmless, 0.0).when(secret, 1.0)).filter("label is not null")


def _tree_sql(node) -> str:
    if node.getClass().getSimpleName() == "LeafNode":
        return str(node.prediction())
    split = node.split()
    left, right = _tree_sql(node.leftChild()), _tree_sql(node.rightChild())
    return f"case when x.f.{NAMES[split.featureIndex()]} <= {split.threshold()!r}D then {left} else {right} end"


def _sampled(examples: DataFrame) -> DataFrame | float:
    """Half of SAMPLE_FINDINGS of each kind at most, over distinct (value, before), those with the
    smallest hashes; the one kind there is if all examples are of one, secrets if there are none."""
    same = examples.groupBy("label", "value", "before").agg(F.min(F.struct("doc_id", "at", "after", "f")).alias("x"))
    keyed = stored(same.select(F.xxhash64("value", "before").alias("key"), "value", "before", "x.after", "x.f", "label"), "examples")
    kinds = sorted(r[0] for r in keyed.select("label").distinct().collect())
    if len(kinds) < 2:
        return kinds[0] if kinds else 1.0
    few = [smallest_hashes(keyed.filter(F.col("label") == k), SAMPLE_FINDINGS // 2, "key", "value", "before") for k in kinds]
    return stored(few[0].union(few[1]), "labelled")


def telling_words(few: DataFrame) -> tuple[str, ...]:
    """The neighbouring words whose presence tells most of a finding's kind, by log-likelihood ratio."""
    around = F.split(F.regexp_replace(F.concat_ws(" ", "before", "after"), "[^a-z]+", " "), " ")
    seen = few.select("label", F.explode(F.array_distinct(F.filter(around, lambda w: F.length(w) >= 2))).alias("word"))
    counts = seen.groupBy("word").agg(F.sum("label").alias("s"), F.sum(1 - F.col("label")).alias("h"))
    totals = {r.label: r["count"] for r in few.groupBy("label").count().collect()}
    n, share = totals[0.0] + totals[1.0], (F.col("s") + F.col("h")) / (totals[0.0] + totals[1.0])

    def part(found: Column, expected: Column) -> Column:
        return F.when(found > 0, found * F.log(found / expected)).otherwise(0.0)

    ratio = (part(F.col("s"), share * totals[1.0]) + part(F.col("h"), share * totals[0.0])
             + part(totals[1.0] - F.col("s"), (1 - share) * totals[1.0]) + part(totals[0.0] - F.col("h"), (1 - share) * totals[0.0]))
    told = counts.filter(F.col("s") + F.col("h") < n).select("word", ratio.alias("ratio")).filter("ratio > 2")
    return tuple(r.word for r in told.orderBy(F.desc("ratio"), "word").limit(NEAR).collect())


def train(few: DataFrame, near: tuple[str, ...], seed: int = 5) -> tuple[str, object, DataFrame]:
    """The forest as SQL over a finding `x`: the share of trees that call it a secret; Spark's model and its input."""
    plain = [F.col(f"f.{n}").alias(n) for n in NAMES if not n.startswith("near")]
    near_flags = [c.alias(n) for n, c in neighbours(F.col("before"), F.col("after"), near).items()]
    rows = few.repartition(1).sortWithinPartitions("key", "value", "before", "label").select(*plain, *near_flags, "label")
    vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, subsamplingRate=0.8).fit(vectors)
    trees = [_tree_sql(tree._call_java("rootNode")) for tree in forest.trees]
    return f"({' + '.join(f'({t})' for t in trees)}) / {len(trees)}D", forest, vectors


def _examples(docs: DataFrame, path: str) -> tuple[Language, DataFrame]:
    known = language(docs)
    found = docs.select("doc_id", F.explode(_flat(findings(known, path))).alias("x")).select("doc_id", "x.*")
    return known, labelled(found)


def fit(docs: DataFrame, path: str = "source") -> tuple[Language, str]:
    """The language of the texts and a forest trained on their labelled findings."""
    known, examples = _examples(docs, path)
    few = _sampled(examples)
    if isinstance(few, float):
        return known, f"{few}D"
    near = telling_words(few)
    return replace(known, near=near), train(few, near)[0]


def held_out_quality(docs: DataFrame, path: str = "source") -> dict[str, float]:
    """Precision and recall on labelled values, a third by hash, that neither words nor forest have seen."""
    known, examples = _examples(docs, path)
    rows = stored(examples, "labelled")
    held = F.pmod(F.xxhash64("value"), F.lit(3)) == 0
    few = _sampled(rows.filter(~held))
    near = () if isinstance(few, float) else telling_words(few)
    forest = f"{few}D" if isinstance(few, float) else train(few, near)[0]
    judged = rows.filter(held).groupBy("label", "value", "before").agg(F.min(F.struct("after", "f")).alias("y"))
    flags = F.struct(*[F.col(f"y.f.{n}").alias(n) for n in NAMES if not n.startswith("near")],
                     *[c.alias(n) for n, c in neighbours(F.col("before"), F.col("y.after"), near).items()])
    scored = judged.select("label", F.struct(flags.alias("f")).alias("x")).select("label", (F.expr(forest) >= THRESHOLD).alias("called"))
    r = scored.agg(F.count_if("called").alias("called"), F.sum("label").alias("secrets"), F.count("*").alias("n"),
                   F.count_if(F.col("called") & (F.col("label") == 1)).alias("both")).first()
    return {"values": r.n, "secrets": int(r.secrets or 0), "precision": r.both / r.called if r.called else 1.0,
            "recall": r.both / r.secrets if r.secrets else 1.0}


def _scored(docs: DataFrame, model: tuple[Language, str], path: str, out: str) -> DataFrame:
    """The documents and, per word, its findings with scores in the column `out`.

    A key in an issuer's format and a value that a secret's name is directly given to are
    secrets; whether any other finding is one, the forest says.
    """
    known, forest = model
    found = docs.withColumn(out, findings(known, path))
    score = f"if(x.value rlike r'{ISSUED}' or (x.before rlike r'{SECRET_NAME}' and x.value rlike r'{NAMED_PLAIN}'), 1.0D, {forest})"
    return found.withColumn(out, F.expr(
        f"transform({out}, found -> transform(found, x -> struct(x.at, x.value, {score} as score)))"))


def scan(docs: DataFrame, model: tuple[Language, str] | None = None, path: str = "source") -> DataFrame:
    """A row per finding: doc_id, at, value, score and is_secret."""
    rows = docs.select("doc_id", "text", path)
    scored = _scored(rows, model or fit(rows, path), path, "found")
    return scored.select("doc_id", F.explode(_flat(F.col("found"))).alias("x")).select(
        "doc_id", "x.at", "x.value", "x.score", (F.col("x.score") >= THRESHOLD).alias("is_secret"))


def redact(docs: DataFrame, model: tuple[Language, str] | None = None, path: str = "source") -> DataFrame:
    """All documents and columns, with REDACTED in the place of each secret value.

    A value is replaced in the word that it was found in, the longest of a word first, so
    that none leaves its tail where another one is its beginning.
    """
    found = unused_name(docs, "found")
    scored = _scored(docs, model or fit(docs, path), path, found)

    def hidden(word: Column, of_word: Column) -> Column:
        values = F.array_sort(
            F.filter(of_word, lambda x: x["score"] >= THRESHOLD), lambda a, b: F.length(b["value"]) - F.length(a["value"]))
        return F.aggregate(values, word, lambda text, x: F.replace(text, x["value"], F.lit(REDACTED)))

    def rebuilt(runs: Column, first: Column) -> Column:
        """Runs of words and of spaces follow each other in turn; `first` is the place of the first word."""
        return F.array_join(F.transform(runs, lambda run, i: F.when(
            F.pmod(i - first, F.lit(2)) == 0, F.coalesce(hidden(run, F.get(F.col(found), ((i - first) / 2).cast("int"))), run))
            .otherwise(run)), "")

    secret = F.exists(found, lambda of_word: F.coalesce(F.exists(of_word, lambda x: x["score"] >= THRESHOLD), F.lit(False)))
    runs = F.regexp_extract_all("text", F.lit(f"{SPACES}|{WORD}"), F.lit(0))
    first = F.col("text").rlike(f"\\A{SPACES}").cast("int")
    parted = _let(F.struct(runs.alias("runs"), first.alias("first")), lambda x: rebuilt(x["runs"], x["first"]))
    text = F.when(secret, parted).otherwise(F.col("text"))
    return scored.withColumn("text", text).select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Findings without the values themselves: their place, length, digest and verdict."""
    return scan(docs).select(
        "doc_id", "at", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")
