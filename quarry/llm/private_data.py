"""Personal data in texts, by weak supervision.

Patterns propose spans: four strict ones, whose valid matches are always
reported, and wider ones for other spellings. Labelers vote on every proposed
span: patterns of its form, gazetteers of domains, card issuers and dialling
codes, and the words and characters around it. Expectation-maximisation
estimates from the votes alone how reliable each labeler is, and the posterior
labels train a logistic model of the spans' features, which decides about the
proposed spans that the strict patterns leave out.

Everything runs on DataFrame and SQL functions. Java's regular expressions
backtrack; the patterns here are the plain ones with possessive loops and
look-behinds that match the same spans in time proportional to the text.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import written

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
#: (kind, strict, pattern, what a text must hold for it to be tried)
PATTERNS = (
    ("email", True, rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_HOST}]++(?:\.[{_HOST}]++)++", ("@",)),
    ("ip", True, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", (".",)),
    ("card", True, r"[0-9](?:[ -]?[0-9])++", ()),
    ("phone", True, r"\+[0-9][ ().0-9-]+[0-9]", ("+",)),
    ("email", False, rf"(?<![{_LOCAL}])[{_LOCAL}]++(?: ?[\[(]at[\])] ?| at |@)[{_HOST}]++(?:(?: ?[\[(]dot[\])] ?| dot )[{_HOST}]++)++",
     ("[dot]", "(dot)", " dot ")),
    ("ip", False, r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", (":",)),
    ("phone", False, r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])", ()),
)
#: Characters on either side that labelers see.
CONTEXT = 40
#: Fixed lists of the gazetteer labelers.
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "biz", "io", "eu", "de", "fr", "es", "uk", "it", "nl", "ch", "at", "us", "ca", "au")
DIALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
            "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92")
#: Words near a span that speak for a kind, and what right before it speaks against any.
CUES = {"email": "mail|contact|write|reach", "ip": r"\bip\b|host|server|address|login", "card": "card|visa|credit|debit|pay",
        "phone": "phone|tel|call|fax|mobil|cell"}
AGAINST = r"(?:version|isbn|issn|order|serial|build|sha|md5|token|key|secret|id|no)[\"' .:=#]*$|[=$€£/_#]$"
LABELERS = ("form", "shape", "gazetteer", "cue", "against", "edges")
#: Features are hashed to so many places.
HASHED = 1 << 12


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def step(total, c):
        d = F.ascii(c) - 48
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.struct((total["s"] + F.when(total["i"] % 2 == 1, twice).otherwise(d)).alias("s"), (total["i"] + 1).alias("i"))

    return F.aggregate(F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("s"), F.lit(0).alias("i")), step, lambda t: t["s"] % 10 == 0)


def valid(kind: Column, match: Column) -> Column:
    """Whether a match of a strict pattern counts."""
    digits = digits_of(match)
    n = F.char_length(digits)
    part = lambda p: F.ltrim(p, F.lit("0"))
    small = F.forall(F.split(match, "\\."), lambda p: (F.char_length(part(p)) <= 2) | ((F.char_length(part(p)) == 3) & (part(p) <= "255")))
    return F.when(kind == "email", True).when(kind == "ip", small).when(kind == "card", n.between(16, 19) & luhn(digits)) \
        .otherwise(n.between(8, 15))


def proposed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_rid, _id, found), written: for each row the matches of all patterns
    with the lengths and ends of the text between them. Texts are read once."""
    rows = docs.select(F.monotonically_increasing_id().alias("_rid"), F.col(id_col).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    holds = {}
    for k, (_, _, pattern, needs) in enumerate(PATTERNS):
        try_it = F.lit(False)
        for x in needs:
            try_it = try_it | F.contains("_text", F.lit(x))
        every = F.regexp_extract_all("_text", F.lit(pattern), 0)
        holds[f"_m{k}"] = F.when(try_it, every) if needs else every
    rows = rows.withColumns(holds)
    rows = rows.withColumns({f"_p{k}": F.when(F.size(f"_m{k}") > 0, F.split("_text", pattern, -1)) for k, (_, _, pattern, _) in enumerate(PATTERNS)})
    def spans(k, kind, strict):
        def span(m, i):
            before, after = F.get(F.col(f"_p{k}"), i), F.get(F.col(f"_p{k}"), i + 1)
            return F.struct(F.lit(k).alias("pattern"), F.lit(kind).alias("kind"), F.lit(strict).alias("strict"), i.alias("i"),
                            F.char_length(before).cast("long").alias("gap"), m.alias("match"), F.right(before, F.lit(CONTEXT)).alias("left"),
                            F.left(after, F.lit(CONTEXT)).alias("right"))

        return F.when(F.size(f"_m{k}") > 0, F.transform(f"_m{k}", span))

    every = [spans(k, kind, strict) for k, (kind, strict, _, _) in enumerate(PATTERNS)]
    none = F.array().cast("array<struct<pattern:int,kind:string,strict:boolean,i:int,gap:bigint,match:string,left:string,right:string>>")
    return written(rows.select("_rid", "_id", F.concat(*[F.coalesce(x, none) for x in every]).alias("found")), "matches")


def possible(kind: Column, match: Column, left: Column, right: Column) -> Column:
    """Whether a proposed span can be personal data at all: a card number
    passes Luhn's check, an address has no part over 255, a telephone number
    has 7 to 15 digits, and none is cut out of a longer word or number."""
    digits = digits_of(match)
    n = F.char_length(digits)
    alone = ~left.rlike("[A-Za-z0-9]$") & ~right.rlike("^[A-Za-z0-9]")
    return alone & F.when(kind == "email", True).when(kind == "ip", F.contains(match, F.lit(":")) | valid(kind, match)) \
        .when(kind == "card", n.between(13, 19) & luhn(digits)).otherwise(n.between(7, 15))


def placed(found: DataFrame) -> DataFrame:
    """A row a proposed span: where it begins and ends (code points), whether
    it is ``base`` (a valid match of a strict pattern) and whether it is
    ``possible``. Spans that overlap a base span and are none are dropped, and
    numbers of under 13 digits, which no labeler takes for a card."""
    each = found.where(F.size("found") > 0).select("_rid", F.explode("found").alias("s")).select("_rid", "s.*").repartition("_rid")
    own = F.char_length("match")
    upto = F.sum(F.col("gap") + own).over(Window.partitionBy("_rid", "pattern").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    each = each.withColumn("end", upto).withColumn("start", F.col("end") - own).withColumn("valid", F.col("strict") & valid(F.col("kind"), F.col("match")))
    by = Window.partitionBy("_rid").orderBy("start")
    before = F.max(F.when(F.col("valid"), F.col("end"))).over(by.rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(F.col("valid"), F.col("start"))).over(by.rangeBetween(0, Window.unboundedFollowing))
    return each.withColumn("_before", before).withColumn("_after", after) \
        .where(F.col("valid") | ((F.coalesce("_before", F.lit(-1)) <= F.col("start")) & (F.col("_after").isNull() | (F.col("_after") >= F.col("end"))))) \
        .where((F.col("kind") != "card") | (F.char_length(digits_of(F.col("match"))) >= 13)) \
        .withColumn("possible", F.col("valid") | possible(F.col("kind"), F.col("match"), F.col("left"), F.col("right"))) \
        .select("_rid", "kind", "possible", F.col("valid").alias("base"), "start", "end", "match", "left", "right")


def vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes() -> dict[str, Column]:
    """What each labeler says of a span: 1 personal data, -1 not, 0 nothing."""
    kind, match = F.col("kind"), F.col("match")
    digits, none = digits_of(match), F.lit(False)
    n = F.char_length(digits)
    top = F.lower(F.regexp_extract(match, "([A-Za-z0-9-]+)$", 1))
    code = F.when(F.startswith(match, F.lit("+")), digits)
    by_kind = lambda **c: F.coalesce(*[F.when(kind == k, v) for k, v in c.items()])
    said = F.lower(F.concat_ws(" ", "left", "right"))
    form = vote(F.col("base"), ~F.col("possible"))
    shape = by_kind(
        email=vote(top.rlike("^[a-z]{2,}$"), ~top.rlike("^[a-z]{2,}$")),
        ip=vote(match.rlike(r"^(?:[1-9][0-9]{0,2}|0)(?:\.(?:[1-9][0-9]{0,2}|0)){3}$|^[0-9A-Fa-f:]+$"), match.rlike(r"[0-9]{4}\.|\.[0-9]{4}")),
        card=vote(match.rlike("^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\\1[0-9]{4}\\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\\2[0-9]{5})$") & luhn(digits),
                  (n < 13) | (n > 19)),
        phone=vote(match.rlike(r"^(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-]?[0-9]{4}$"), (n < 7) | (n > 15)))
    gazetteer = by_kind(
        email=vote(top.isin(*DOMAINS), none), ip=vote(none, match.rlike(r"^(?:0|127|255)\.")),
        card=vote(digits.rlike("^[3-6]") & (n > 12), digits.rlike("^[0127-9]")),
        phone=vote(F.substring(code, 1, 1).isin(*DIALLING) | F.substring(code, 1, 2).isin(*DIALLING), code.isNull() & digits.rlike("^[01]")))
    cue = by_kind(**{k: vote(said.rlike(p), none) for k, p in CUES.items()})
    against = vote(none, F.lower("left").rlike(AGAINST))
    edges = vote((F.col("left") == "") | F.col("left").rlike(r"[\s(<\[,;:\"']$"), F.col("left").rlike("[A-Za-z0-9]$") | F.col("right").rlike("^[A-Za-z0-9]"))
    return dict(zip(LABELERS, (form, shape, gazetteer, cue, against, edges)))


def features() -> Column:
    """What the final model sees of a span: its kind with each vote, its
    shape (runs of digits and letters), and what stands next to it."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("match", "[A-Za-z]+", "a"), "[0-9]{7,}", "9+"), "[0-9]", "9")
    said = [F.concat_ws(":", "kind", F.lit(k), F.col(f"v.{k}").cast("string")) for k in LABELERS[1:]]
    near = lambda c, p: F.concat_ws(":", "kind", F.lit(c), F.regexp_replace(F.regexp_extract(c, p, 0), "[A-Za-z]", "a"))
    return F.array(*said, F.concat_ws(":", "kind", F.left(shape, F.lit(24))), near("left", ".$"), near("right", "^."))


def reliabilities(patterns: list[tuple[dict, float]], steps: int = 50) -> tuple[float, dict, list[float]]:
    """(share of personal data, P(vote | label) of each labeler, posterior of
    each pattern of votes) by expectation-maximisation over (votes, count).
    It starts from the sum of votes; a prior of ten spans, that a labeler who
    speaks is right three times of four, keeps the two labels from swapping.
    What ``form`` says is certain: it speaks only of valid matches of the
    strict patterns and of what can't be personal data."""
    def sure(v, p):
        return {1: 1.0, -1: 0.0}.get(v["form"], p)

    prior = {1: {1: 5.0, 0: 3.3, -1: 1.7}, 0: {1: 1.7, 0: 3.3, -1: 5.0}}
    post = [sure(v, 1 / (1 + math.exp(-sum(v.values())))) for v, _ in patterns]
    share, said = 0.5, {}
    for _ in range(steps):
        total = sum(n for _, n in patterns)
        share = (sum(p * n for p, (_, n) in zip(post, patterns)) + 5) / (total + 10)
        said = {}
        for k in LABELERS:
            for y in (0, 1):
                c = dict(prior[y])
                for p, (v, n) in zip(post, patterns):
                    c[v[k]] += n * (p if y else 1 - p)
                whole = sum(c.values())
                said[k, y] = {x: m / whole for x, m in c.items()}
        new = []
        for v, _ in patterns:
            odds = math.log(share / (1 - share)) + sum(math.log(said[k, 1][v[k]] / said[k, 0][v[k]]) for k in LABELERS[1:])
            new.append(sure(v, 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))))
        moved = max((abs(a - b) for a, b in zip(new, post)), default=0)
        post = new
        if moved < 1e-9:
            break
    return share, said, post


def posteriors(spans: DataFrame) -> dict[str, Column]:
    """kind -> posterior as an expression of the votes ``v``. The driver sees
    one count a kind and pattern of votes: 4 * 3**6 at most."""
    by: dict[str, list] = {k: [] for k in KINDS}
    for r in spans.groupBy("kind", "v").agg(F.count(F.lit(1)).alias("n")).collect():
        by[r["kind"]].append((r["v"].asDict(), float(r["n"])))
    out = {}
    for kind, patterns in by.items():
        share, said, _ = reliabilities(patterns)
        odds = F.lit(math.log(share / (1 - share)))
        for k in LABELERS[1:] if said else ():
            w = {x: math.log(said[k, 1][x] / said[k, 0][x]) for x in (-1, 0, 1)}
            odds = odds + F.when(F.col(f"v.{k}") == 1, w[1]).when(F.col(f"v.{k}") == -1, w[-1]).otherwise(w[0])
        out[kind] = F.when(F.col("v.form") == 1, 1.0).when(F.col("v.form") == -1, 0.0).otherwise(1 / (1 + F.exp(-odds)))
    return out


def private_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """(id, spans): for every row the spans (kind, start, end, match, base,
    score) of personal data, by kind as in ``KINDS``, then start. Starts and
    ends are code points, ends exclusive.

    ``base`` spans are the valid matches of the strict patterns (leftmost, not
    overlapping within a kind) and always stay. Others are added where they
    are ``possible`` and the model gives them ``least`` or more; one that
    begins within another added span that begins before it is not. Null and empty texts have no spans;
    repeated rows and null ids are rows of their own; other columns are
    ignored; without any proposed span nothing is fitted.
    """
    found = proposed(docs, id_col, text_col)
    spans = placed(found).withColumn("v", F.struct(*[c.cast("int").alias(k) for k, c in votes().items()]))
    spans = written(spans.withColumn("features", features()).drop("left", "right"), "spans")
    base = spans.where("base").withColumn("score", F.lit(1.0))
    kept = base
    if not spans.isEmpty():
        p = F.coalesce(*[F.when(F.col("kind") == k, c) for k, c in posteriors(spans).items()])
        # equal features are one row of the fit: labelled 1 by the posteriors' sum, 0 by the rest
        same = spans.groupBy("features").agg(F.sum(p).alias("yes"), F.sum(1 - p).alias("no"))
        rows = same.select("features", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("yes").alias("weight")),
                                                         F.struct(F.lit(0.0).alias("label"), F.col("no").alias("weight")))).alias("r")) \
            .select("features", "r.*").where("weight > 0")
        hashing = HashingTF(numFeatures=HASHED, inputCol="features", outputCol="x", binary=True)
        fit = written(rows, "fit")
        if fit.select("label").distinct().count() == 2:
            model = LogisticRegression(featuresCol="x", weightCol="weight", maxIter=25, regParam=1e-4, standardization=False).fit(hashing.transform(fit))
            others = model.transform(hashing.transform(spans.where("possible and not base"))) \
                .withColumn("score", vector_to_array("probability")[1]).where(F.col("score") >= least)
            earlier = F.max("end").over(Window.partitionBy("_rid").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1))
            kept = base.unionByName(others.withColumn("_e", earlier).where("_e is null or _e <= start").select(*base.columns))
    number = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS)])
    by_row = kept.groupBy("_rid").agg(F.sort_array(F.collect_list(F.struct(
        number.alias("number"), "start", "end", "kind", "match", "base", "score"))).alias("s"))
    plain = F.transform("s", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                                                x["match"].alias("match"), x["base"].alias("base"), x["score"].alias("score")))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,match:string,base:boolean,score:double>>")
    return found.select("_rid", "_id").join(by_row, "_rid", "left") \
        .select(F.col("_id").alias(id_col), F.coalesce(plain, none).alias("spans"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
