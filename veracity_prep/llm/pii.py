"""Personal data: candidate spans from high-recall generators, scored by boosted trees, chosen by calibrated thresholds.

Base kinds (email, ip, card, phone) come from fixed patterns with their checks and are always reported. Two further
generators propose spans with high recall: addresses in disguise ("name (at) host dot org") and runs of digits with
separators. Proposals overlap each other and the base spans. Gradient-boosted trees score a proposal by its format
(length, digits, groups, separators, letters) and its context (words before and after, neighbouring characters), and
are applied as column expressions. Only proposals that overlap no base span are ever added, so only such are examples:

- positive: the base e-mail addresses and phone numbers of all documents, each written in the forms of ``DISGUISES``
  and left in its context, as the generator finds it there;
- negative: all proposals that overlap no base span, unless they have the shape of a positive (such ones may be what is
  looked for, and are no examples of either class);
- ``seeds``: a few hundred fixed examples of both classes, so that a small or a plain table has a model as well.

The threshold of each generator is the lowest from 0.5 on at which ``PRECISION`` of the held-out proposals are
positive; without such a threshold the generator adds nothing. Chosen proposals that overlap no base span are reported
under the kinds ``address`` and ``number``; of overlapping ones the higher score stays, then the earlier. A run of
digits without separators is a number only if a word beside it says so.

Each document is worked on in its own row: no shuffle, no Python in the tasks. Offsets count code points, ends are
exclusive. Null and empty texts have no spans; repeated rows are scored each; extra columns are kept or ignored by
name.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity_prep.llm.shared import cut
from veracity_prep.llm.spans import cuts, let, listed, places

#: Fixed patterns of the base kinds, in linear form: runs are entered at their start only and never given back.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")
#: Generators of proposals.
AT, DOT = r"(?:@|[(\[{<]\x20?(?i:at)\x20?[)\]}>])", r"(?:\.|[(\[{<]\x20?(?i:dot)\x20?[)\]}>]|\x20(?i:dot)\x20)"
ADDRESS = rf"[A-Za-z0-9][A-Za-z0-9._%+-]{{0,63}}+(?:\x20?{AT}\x20?|\x20(?i:at)\x20(?=[A-Za-z0-9-]{{1,60}}+\x20(?i:dot)\x20))[A-Za-z0-9-]{{1,60}}+(?:\x20?{DOT}\x20?[A-Za-z0-9-]{{1,60}}+){{1,6}}+"
NUMBER = r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,40}+"
PROPOSED = {"address": ADDRESS, "number": NUMBER}
HINTS = {"address": r"@|[(\[{<]\x20?(?i:at)\x20?[)\]}>]|\x20(?i:at)\x20[A-Za-z0-9-]+\x20(?i:dot)\x20", "number": r"[0-9](?:[\x20().-]{0,2}[0-9]){6}"}
WORDS = r"(?i)mail|contact|write|tel|phone|call|mobile|fax|card|visa|account|iban|ssn|social|addr|host|server|\bip\b"

PRECISION = 0.98
TREES, DEPTH, RATE = 12, 3, 0.3
FEATURES = ("length", "digits", "groups", "dots", "dashes", "blanks", "brackets", "at", "plus", "letters", "last_digit", "word_before", "word_after", "tight_before", "tight_after", "longest", "first_group", "last_group", "at_word", "dot_word", "tail_letters", "sentence_end")


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid check digit."""

    def worth(at: Column) -> Column:
        value = F.substring(digits, F.length(digits) - at, F.lit(1)).cast("int")
        return F.when(at % 2 == 0, value).when(value > 4, value * 2 - 9).otherwise(value * 2)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda s, at: s + worth(at)) % 10 == 0


def small_enough(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) < 3) | (F.length(bare) == 3) & (bare <= "255")


def valid(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), small_enough)
    if kind == "phone":
        return F.length(digits_of(hit)).between(9, 15)
    return let(digits_of(hit), lambda d: F.when(F.length(d).between(13, 19), passes_luhn(d)).otherwise(False))


def checked(kind: str) -> Callable[[Column], Column]:
    return lambda p: valid(kind, p["hit"])


def named(kind: str, found: Column) -> Column:
    """Places as spans of a kind."""
    return F.transform(found, lambda p: F.struct(F.lit(kind).alias("kind"), p["start"].alias("start"), p["end"].alias("end")))


def unbeaten(rivals: Column, first: bool) -> Callable[[Column], Column]:
    """Whether no overlapping rival scores higher, or as high if rivals come ``first``."""

    def over(p: Column, q: Column) -> Column:
        higher = q["score"] >= p["score"] if first else q["score"] > p["score"]
        return (q["start"] < p["end"]) & (p["start"] < q["end"]) & higher

    return lambda p: ~F.exists(rivals, lambda q: over(p, q))


def base_places(text: Column) -> dict[str, Column]:
    """What ``cuts`` finds of each base kind; a cheap look at the text spares the pattern where it can't match."""
    return {
        "email": cuts(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": cuts(text, IP, text.rlike(r"[0-9]\.[0-9]")),
        "card": cuts(text, CARD, text.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9]")),
        "phone": cuts(text, PHONE, text.rlike(r"\+[0-9]")),
    }


def features(place: Column) -> dict[str, Column]:
    hit, before, after = place["hit"], place["before"], place["after"]
    count = lambda pattern: F.length(F.regexp_replace(hit, pattern, ""))
    groups = F.size(F.split(hit, "[^0-9]+"))
    values = (
        F.length(hit), F.length(digits_of(hit)), groups, count(r"[^.]"), count("[^-]"), count(r"[^\x20]"), count(r"[^()\[\]]"), count("[^@]"), count("[^+]"), count("[^A-Za-z]"),
        F.substring(hit, -1, 1).rlike("[0-9]"), before.rlike(WORDS), after.rlike(WORDS), F.substring(before, -1, 1).rlike("[A-Za-z0-9]"), F.substring(after, 1, 1).rlike("[A-Za-z0-9]"), F.array_max(F.transform(F.split(hit, "[^0-9]+"), F.length)),
        F.length(F.regexp_extract(hit, "[0-9]+", 0)), F.length(F.regexp_extract(hit, "[0-9]*$", 0)), hit.rlike("(?i)[^a-z]at[^a-z]"), hit.rlike("(?i)[^a-z]dot[^a-z]"), F.length(F.regexp_extract(hit, "[A-Za-z]*$", 0)), hit.rlike(r"[^\x20]\.\x20"),
    )
    return {n: v.cast("double") for n, v in zip(FEATURES, values, strict=True)}


def with_candidates(docs: DataFrame, prefix: str) -> DataFrame:
    """``docs`` with base spans (``kind, start, end``) in one column and places of each generator in others."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.withColumns({f"{prefix}{k}": c for k, c in base_places(text).items()})
    found = found.withColumns({f"{prefix}{k}": cuts(text, p, text.rlike(HINTS[k])) for k, p in PROPOSED.items()})
    spans = [named(k, F.filter(places(F.col(f"{prefix}{k}")), checked(k))) for k in BASE]
    found = found.withColumn(f"{prefix}base", F.concat(*spans)).drop(*(f"{prefix}{k}" for k in BASE))
    return found.withColumns({f"{prefix}{k}": places(F.col(f"{prefix}{k}")) for k in PROPOSED})


class Model:
    """Boosted trees as plain tuples, and a threshold for each generator."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[str, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def score(self, place: Column) -> Column:
        def of(node: tuple, values: Column) -> Column:
            if len(node) == 1:
                return F.lit(node[0])
            feature, threshold, left, right = node
            return F.when(values[feature] <= threshold, of(left, values)).otherwise(of(right, values))

        margin = lambda values: sum((of(t, values) * w for t, w in zip(self.trees, self.weights, strict=True)), F.lit(0.0))
        return let(F.array(*features(place).values()), lambda v: 1 / (1 + F.exp(-2 * margin(v))))


def tree_of(node) -> tuple:
    """A fitted tree as (prediction,) or (feature, threshold, left, right)."""
    if node.subtreeDepth() == 0:
        return (float(node.prediction()),)
    return (node.split().featureIndex(), float(node.split().threshold()), tree_of(node.leftChild()), tree_of(node.rightChild()))


def above(threshold: float) -> Callable[[Column], Column]:
    return lambda p: p["score"] >= threshold


def overlapping(place: Column, spans: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < place["end"]) & (place["start"] < s["end"]))


def in_disguise(kind: str, hit: Column) -> list[Column]:
    """The forms in which an e-mail address or a phone number with + is written to be an example."""
    if kind == "email":
        name, host = F.regexp_extract(hit, "^[^@]*", 0), F.regexp_extract(hit, "[^@]*$", 0)
        return [F.concat(name, F.lit(at), F.regexp_replace(host, r"\.", dot)) for at, dot in DISGUISES]
    bare = F.substring(hit, F.lit(2), F.length(hit))
    home = F.regexp_replace(bare, r"^[0-9]{1,3}[\x20.-]+", "")  # without the country
    groups = F.filter(F.split(home, "[^0-9]+"), lambda g: g != "")
    return [bare, home, *(F.array_join(groups, by) for by in "-. ")]


#: How @ and . of an address are written.
DISGUISES = ((" (at) ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), ("@", " dot "), (" @ ", " . "), (" AT ", " DOT "), (" at ", " dot "))


def seeds() -> list[tuple[str, str, str, str, float]]:
    """Fixed examples: ``generator, before, planted, after, label``."""
    rng = random.Random(9)
    # Shapes that aren't anybody's number: dates, versions, addresses out of range, cards, counters, ranges, prices.
    yes = ("(###) ###-####", "1 (###) ###-####", "###-###-####", "1-###-###-####", "###.###.####", "### ### ####", "0## #### ####", "0### ######", "0## ########", "0# ## ## ## ##", "(0##) #### ####", "0##-###-####", "44 20 #### ####", "49 30 ########")
    no = ("20##-0#-1#", "1#.0#.20##", "#.##.###.####", "9##.9##.###.##", "################", "#### #### #### ####", "#######", "########", "#########", "##########", "############", "1###-1### 20##-20##", "##.###.###", "# ### ### ###", "97# # ## ###### #", "20##0#1# ######", "###-##-#####-#", "#.####### #.#######")
    words = ("we went there", "und dann war es", "la casa de", "il y avait", "see the", "and then", "so it is", "of the")
    cues = ("call me at", "phone", "tel", "fax", "mobile", "please contact", "write to", "my address is")
    fill = lambda shape: "".join(str(rng.randint(0, 9)) if c == "#" else c for c in shape)
    name = lambda: "".join(rng.choice("abcdefghiklmnoprstuw") for _ in range(rng.randint(3, 9)))
    some = lambda: rng.choice(words + cues)
    out = []
    for _ in range(10):
        out += [("number", f"{some()} ", fill(x), f" {rng.choice(words)}", 1.0) for x in yes]
        out += [("number", f"{rng.choice(cues[:6])} ", fill("##########"), f" {rng.choice(words)}", 1.0)]
        out += [("number", f"{rng.choice(words)} ", fill(x), f" {rng.choice(words)}", 0.0) for x in no]
        for at, dot in DISGUISES:
            host = dot.join([name(), rng.choice(("com", "org", "net", "de", "fr", "io", "example"))])
            user = rng.choice((name(), f"{name()}.{name()}", f"{name()}{rng.randint(1, 99)}"))
            out += [("address", f"{some()} ", f"{user}{at}{host}", f" {rng.choice(words)}", 1.0)]
        for shape in ("{a} @ {b}. {C}", "{a} (at) {b}. {C}", "{a} @ {d}.{d}", "{a} @ ${d}", "{d} @ {d}.{d}", "{a} [at] {b}. {C} {b}", "@{a} {b}.", "{d} @ {b}. {C}"):
            text = shape.format(a=name(), b=name(), C=name().capitalize(), d=rng.randint(1, 99))
            out += [("address", f"{rng.choice(words)} ", text, f" {rng.choice(words)}", 0.0)]
    return out


def shape(place: Column) -> Column:
    """The form of a proposal: letters and digits of an address as one sign, digits of a number each; a bare run also by the words beside it."""
    hit = F.regexp_replace(place["hit"], "[0-9]", "9")
    word = F.regexp_replace(F.regexp_replace(hit, r"(?i)[^A-Za-z0-9]dot[^A-Za-z0-9]", "."), "[A-Za-z0-9_%+-]+", "a")
    cue = F.when(hit.rlike("^9+$"), (place["before"].rlike(WORDS) | place["after"].rlike(WORDS)).cast("string")).otherwise("")
    dotted = F.regexp_replace(F.regexp_replace(word, r"^[a.]+", "a"), r"a(?:\x20?\.\x20?a)+$", "a.a")
    sentence = hit.rlike(r"[^\x20]\.\x20").cast("string")
    return F.when(hit.rlike("[A-Za-z@]"), F.concat(dotted, sentence)).otherwise(F.concat(hit, cue))


def planted(rows: DataFrame) -> DataFrame:
    """``key, generator, label, p`` of the proposals that cover what is ``planted`` between ``before`` and ``after``."""
    lo = F.length("before")
    out = []
    for k, pattern in PROPOSED.items():
        found = rows.where(F.col("generator") == k).withColumn("text", F.concat("before", "planted", "after"))
        found = found.withColumn("found", cuts(F.col("text"), pattern)).withColumn("p", F.explode(places(F.col("found"))))
        covers = (F.col("p.start") <= lo) & (F.col("p.end") >= lo + F.length("planted"))
        # A negative may be proposed in part.
        touches = (F.col("p.start") < lo + F.length("planted")) & (F.col("p.end") > lo)
        out.append(found.where(covers | touches & (F.col("label") == 0)).select("key", "generator", "label", "p"))
    return out[0].unionByName(out[1])


def examples_of(docs: DataFrame) -> DataFrame:
    """``key, generator, label`` and the features of all examples; ``key`` decides which half they are in."""
    spark = docs.sparkSession
    texts = docs.where("text is not null").select("text", F.xxhash64("text").alias("key"))
    hinted = texts.where(F.col("text").rlike(HINTS["number"]) | F.col("text").rlike(HINTS["address"]))
    shown = base_places(F.col("text"))
    sources = {"email": "address", "phone": "number"}
    found = with_candidates(hinted, "c_").select("key", "c_base", *(f"c_{k}" for k in PROPOSED), *(F.filter(places(shown[k]), checked(k)).alias(f"c_{k}") for k in sources))
    # The matches are looked for once; what follows reads them.
    found = cut(found, "candidates")
    free = [found.select("key", F.lit(k).alias("generator"), F.lit(0.0).alias("label"), F.explode(F.filter(f"c_{k}", lambda p: ~overlapping(p, F.col("c_base")))).alias("p")) for k in PROPOSED]
    forms = []
    for kind, generator in sources.items():
        spans = found.select("key", F.explode(f"c_{kind}").alias("s"))
        form = F.explode(F.array(*in_disguise(kind, F.col("s.hit")))).alias("planted")
        forms.append(spans.select("key", F.lit(generator).alias("generator"), F.col("s.before").alias("before"), form, F.col("s.after").alias("after"), F.lit(1.0).alias("label")))
    fixed = spark.createDataFrame(seeds(), "generator string, before string, planted string, after string, label double")
    fixed = fixed.withColumn("key", F.xxhash64("before", "planted", "after")).select(forms[0].columns)
    parts = {"free": free[0].unionByName(free[1]), "made": planted(forms[0].unionByName(forms[1])), "fixed": planted(fixed)}
    both = reduce(DataFrame.unionByName, (d.withColumn("origin", F.lit(k)) for k, d in parts.items()))
    row = both.select("key", "generator", "label", "origin", shape(F.col("p")).alias("shape"), *(v.alias(n) for n, v in features(F.col("p")).items()))
    row = cut(row.distinct(), "proposals")  # a document and its copies count once
    known = row.where("label = 1").select("generator", "shape").distinct()
    unlike = row.where("origin = 'free'").join(known, ["generator", "shape"], "left_anti").select(row.columns)
    out = unlike.unionByName(row.where("origin <> 'free'"))
    return cut(out, "examples")


def train(docs: DataFrame) -> Model:
    """Trees and thresholds from the examples; a half of them, by a hash of the text, is held out for the thresholds."""
    examples = examples_of(docs)
    half = F.pmod(F.xxhash64("key", F.lit("half")), F.lit(2))
    fit, held = examples.where(half == 0), examples.where(half == 1)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=9, maxBins=64).fit(vectors.transform(fit).select("label", "features"))
    model = Model([tree_of(t._call_java("rootNode")) for t in fitted.trees], list(fitted.treeWeights), {})
    scored = held.select("generator", "label", F.round(1 / (1 + F.exp(-2 * margin_of(model))), 2).alias("score"))
    levels = scored.groupBy("generator", "score").agg(F.count("*").alias("n"), F.sum("label").alias("good")).collect()  # 101 levels at most for each
    for k in PROPOSED:
        n = good = 0
        for level in sorted((x for x in levels if x.generator == k), key=lambda x: -x.score):
            n, good = n + level.n, good + level.good
            if n >= 20 and good >= PRECISION * n and level.score >= 0.5:
                model.thresholds[k] = level.score
    return model


def margin_of(model: Model) -> Column:
    def of(node: tuple) -> Column:
        return F.lit(node[0]) if len(node) == 1 else F.when(F.col(FEATURES[node[0]]) <= node[1], of(node[2])).otherwise(of(node[3]))

    return sum((of(t) * w for t, w in zip(model.trees, model.weights, strict=True)), F.lit(0.0))


def personal_spans(docs: DataFrame, column: str, model: Model | None = None) -> DataFrame:
    """``docs`` with ``column``: spans (``kind, start, end``), base kinds in their order and by start, then chosen proposals."""
    model = model or train(docs)
    prefix = f"{column}_"
    found = with_candidates(docs, prefix)
    added = [F.col(f"{prefix}base")]
    for k in PROPOSED:
        if k in model.thresholds:
            free = F.filter(f"{prefix}{k}", lambda p: ~overlapping(p, F.col(f"{prefix}base")))
            scored = F.transform(free, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), model.score(p).alias("score")))
            found = found.withColumn(f"{prefix}{k}_scored", F.filter(scored, above(model.thresholds[k])))
    chosen = [k for k in PROPOSED if k in model.thresholds]
    for n, k in enumerate(chosen):
        mine = F.col(f"{prefix}{k}_scored")
        # Proposals of one generator never overlap each other; a later generator's yields unless it scores higher.
        for m, other in enumerate(chosen):
            if other != k:
                mine = F.filter(mine, unbeaten(F.col(f"{prefix}{other}_scored"), m < n))
        added.append(named(k, mine))
    found = found.withColumn(column, F.concat(*added))
    return found.drop(*(c for c in found.columns if c.startswith(prefix)))


def digests(docs: DataFrame) -> DataFrame:
    """For each row: doc_id, the numbers of base spans, the SHA-256 of their list, and the list of all spans."""
    found = personal_spans(docs.select("doc_id", "text"), "found").drop("text")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *(count(k) for k in BASE), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def redacted(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; ``column`` is a name that ``docs`` hasn't.

    Spans that overlap are replaced as one, by the kind of the first.
    """
    found = personal_spans(docs, column)
    kind = "array<struct<start:bigint,end:bigint,kind:string>>"

    def joined(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))))
        return F.when((F.size(done) > 0) & (F.coalesce(last["end"], F.lit(0)) > s["start"]), grown).otherwise(F.concat(done, F.array(s)))

    ordered = F.array_sort(F.transform(column, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    merged = F.aggregate(ordered, F.array().cast(kind), joined)

    def replaced(spans: Column) -> Column:
        text = F.col("text")
        ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["end"]))
        pieces = F.zip_with(spans, F.slice(ends, F.lit(1), F.size(spans)), lambda s, e: F.concat(F.substring(text, (e + 1).cast("int"), (s["start"] - e).cast("int")), F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.concat(F.array_join(pieces, ""), F.substring(text, (F.element_at(ends, -1) + 1).cast("int"), F.lit(2**31 - 1)))

    return found.withColumn("text", F.when(F.size(column) > 0, let(merged, replaced)).otherwise(F.col("text"))).drop(column)
