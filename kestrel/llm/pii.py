"""Personal data by weak supervision: labelling functions, EM over their votes, a span classifier.

1. Patterns give candidate spans: the four base kinds (email, ip, card, phone), looser forms
   (spelled-out emails, national phone numbers, IPv6, long digit groups that fail the card check), and
   secrets (keys, tokens, passwords: long runs of letters and digits).
2. Labelling functions vote on each candidate: the strict pattern, a validity check (of a secret: how mixed its
   characters are), gazetteers (top-level domains, calling codes, issuer prefixes, prefixes of issued keys and the
   names that secrets are assigned to), context words before the span, and clean borders. The pattern and the context say yes or abstain, the others yes or no.
3. Expectation-maximisation over the table of distinct vote patterns (at most 2 ** 5 rows per kind)
   estimates each function's hit and false alarm rates, starting from and held near what is believed of them,
   and a probability per pattern.
4. A naive Bayes span classifier is trained on all candidates with these soft labels; it accepts
   a loose span from ``ACCEPT`` on. Base spans always stay; a loose one that overlaps a base span goes.

All steps are DataFrame functions: the texts are read once into a narrow table of candidates
(written to the shared folder), EM is a fold over one small row, the classifier's weights are one
row per feature value. Positions come from the text between matches, so a text costs time linear in
its length. Patterns are possessive, and start only where a match can, for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]      # with a strict pattern; secrets only come from the labelling functions
ACCEPT = 0.9
EM_ROUNDS = 25

# The base patterns, written so that no failed start is tried again inside a run.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Looser forms.
SPELLED = r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63}+){1,6}+"
NATIONAL = r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])"
IPV6 = r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
# A run of 16 or more characters that keys are made of, with a digit and a letter in it.
SECRET = r"(?:(?<![A-Za-z0-9+/_-])|\G)(?=[+/_-]*+[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}+={0,2}"

# Gazetteers and context words of the labelling functions.
TLDS = r"(\.|dot[)\]]) ?(com|org|net|edu|gov|info|io|de|fr|es|uk|eu|us|it|nl|ch|at|be|ca)$"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
CALLING_CODES = r"^(\+(1|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])|\(?[2-9])"
SECRET_NAMES = r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential|signature)[A-Za-z_\x20\"']*[=:]?[\x20\"']*$"
ISSUED_KEYS = r"^(AKIA|ASIA|AIza|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abprs]-|sk_live_|pk_live_|sk-|eyJ)"
CONTEXT = (r"(?i)(mail|contact|write)", r"(?i)(\bip\b|host|server|address)", r"(?i)(card|visa|pay|credit)", r"(?i)(call|tel|phone|fax|mobile)",
           r"[=:][\x20\"']*$")
# The functions, and what is believed of them before any vote is seen: how often they say yes on
# personal data and on other spans. The strict pattern and the context words only ever say yes.
FUNCTIONS = ("pattern", "valid", "known", "context", "clean")
HIT = (0.99, 0.99, 0.8, 0.9, 0.9)
FALSE_ALARM = (0.3, 0.3, 0.4, 0.3, 0.5)
BELIEF = 0.5     # weight of that belief, as a share of the votes
N_VOTES = len(FUNCTIONS)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def term(i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        two = d * 2
        return F.when(i % 2 == 1, F.when(two > 9, two - 9).otherwise(two)).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda s, i: s + term(i))
    return total % 10 == 0


def _parts_fit(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3) & (
        F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("int"), F.lit(0)) <= 255))


def _matches(text: str, guard: Column, pattern: str, kind: int, keep, base) -> Column:
    """array<struct<kind, start, end, base, m, before, after>> of one pattern's matches."""
    t = F.col(text)
    found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    gaps = F.split(t, pattern, -1)
    none = F.array().cast("array<struct<kind:int,start:int,end:int,base:boolean,m:string,before:string,after:string>>")

    def fold(v):
        def add(s, x):
            start = s["pos"] + F.length(x["g"])
            end = start + F.length(x["m"])
            span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), base(x["m"]).alias("base"),
                            x["m"].alias("m"), F.right(x["g"], F.lit(24)).alias("before"), F.left(x["n"], F.lit(2)).alias("after"))
            return F.struct(end.alias("pos"), F.when(keep(x["m"]), F.array_append(s["out"], span)).otherwise(s["out"]).alias("out"))
        each = F.transform(v["f"], lambda m, i: F.struct(m.alias("m"), F.get(v["g"], i).alias("g"), F.get(v["g"], i + 1).alias("n")))
        return F.aggregate(each, F.struct(F.lit(0).alias("pos"), none.alias("out")), add, lambda s: s["out"])

    got = F.get(F.transform(F.array(F.struct(found.alias("f"), gaps.alias("g"))), fold), F.lit(0))
    return F.coalesce(F.when(guard, got), none)


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text_key and one row per candidate span (one with null kind for a text without)."""
    t, yes, no = F.col(text), (lambda m: F.lit(True)), (lambda m: F.lit(False))
    digit = t.rlike("[0-9]")
    n_digits = lambda m: F.length(_digits(m))
    card = lambda m: n_digits(m).between(12, 19) & _luhn(_digits(m))
    spans = F.concat(
        _matches(text, t.contains("@"), EMAIL, 0, yes, yes),
        _matches(text, digit, IP, 1, _parts_fit, yes),
        _matches(text, digit, CARD, 2, lambda m: n_digits(m).between(12, 19), card),
        _matches(text, t.contains("+"), PHONE, 3, lambda m: n_digits(m).between(9, 15), yes),
        _matches(text, t.rlike(r"(?i)[(\[]at[)\]]"), SPELLED, 0, yes, no),
        _matches(text, t.rlike(r"[0-9]{3}[\x20.-][0-9]{4}"), NATIONAL, 3, yes, no),
        _matches(text, t.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"), IPV6, 1, yes, no),
        _matches(text, t.rlike(SECRET), SECRET, 4, yes, no))
    return (docs.select("doc_id", F.xxhash64(text).alias("text_key"), F.explode_outer(spans).alias("_s"))
            .select("doc_id", "text_key", "_s.*"))


def votes(cands: DataFrame) -> DataFrame:
    """``cands`` with ``votes`` (1 yes, 0 no, null abstains, per labelling function) and ``feats``."""
    kind, m = F.col("kind"), F.col("m")
    digits = _digits(m)

    def by_kind(*cols):
        out = F.lit(False)
        for i, c in enumerate(cols):
            out = F.when(kind == i, c).otherwise(out)
        return out

    # a key changes between digits and letters often, and has many of both
    letters, changes = F.length(F.regexp_replace(m, "[^A-Za-z]", "")), F.length(F.regexp_replace(F.regexp_replace(F.regexp_replace(m, "[0-9]+", "9"), "[A-Za-z]+", "a"), "[^9a]", ""))
    mixed = (F.length(digits) >= 3) & (letters >= 3) & (changes >= 5)
    valid = by_kind(m.rlike(r"[A-Za-z]{2,24}$"), ~m.rlike(r"^(0|255)\b|\.0[0-9]"), F.coalesce(_luhn(digits), F.lit(False)) & (F.length(digits) > 0),
                    F.length(digits).between(10, 15), mixed)
    known = by_kind(F.lower(m).rlike(TLDS), m.rlike(r"^(1?[0-9]?[1-9]|1[0-9]0|2[01][0-9]|22[0-3])\."), digits.rlike(ISSUERS),
                    m.rlike(CALLING_CODES), m.rlike(ISSUED_KEYS) | F.col("before").rlike(SECRET_NAMES))
    context = by_kind(*[F.col("before").rlike(p) for p in CONTEXT])
    clean = ~F.col("before").rlike(r"[A-Za-z0-9]$") & ~F.col("after").rlike(r"^[A-Za-z0-9]")
    yes_only = lambda c: F.when(c, F.lit(1))
    flags = [yes_only(F.col("base")), valid.cast("int"), known.cast("int"), yes_only(context), clean.cast("int")]
    shape = F.regexp_replace(F.regexp_replace(m, "[0-9]+", "9"), "[A-Za-z]+", "a")
    feats = F.array(F.concat(F.lit("k"), kind, F.lit(":base="), F.col("base").cast("string")),
                    F.concat(F.lit("k"), kind, F.lit(":valid="), valid.cast("string")),
                    F.concat(F.lit("k"), kind, F.lit(":known="), known.cast("string")),
                    F.concat(F.lit("k"), kind, F.lit(":ctx="), context.cast("string")),
                    F.concat(F.lit("k"), kind, F.lit(":clean="), clean.cast("string")),
                    F.concat(F.lit("k"), kind, F.lit(":seps="), F.least(F.length(F.regexp_replace(shape, "[9a]", "")), F.lit(9))),
                    F.concat(F.lit("k"), kind, F.lit(":len="), F.least(F.expr("length(m) div 4"), F.lit(12))))
    return (cands.where("kind is not null")
            .select("doc_id", "text_key", "kind", "start", "end", "base", F.array(*flags).alias("votes"), feats.alias("feats")))


def reliabilities(voted: DataFrame, rounds: int = EM_ROUNDS) -> DataFrame:
    """kind, rates (hit and false alarm rate per function, prior) by EM over the vote patterns."""
    patterns = voted.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n"))
    rows = patterns.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("p"))
    start = F.struct(F.lit(0.5).alias("prior"), F.array(*map(F.lit, HIT)).alias("hit"), F.array(*map(F.lit, FALSE_ALARM)).alias("miss"))

    def step(s, _):
        def soft(x):
            return F.struct(x["votes"].alias("v"), (x["n"] * posterior(s, x["votes"])).alias("y"), x["n"].alias("n"))

        def update(w):
            def total(f):
                return F.aggregate(w, F.lit(0.0), lambda a, x: a + f(x))

            held = BELIEF * total(lambda x: x["n"]) + 1.0

            def rates(weight, believed):
                def rate(i):
                    vote = lambda x: F.get(x["v"], F.lit(i))
                    said_yes = total(lambda x: weight(x) * F.coalesce(vote(x), F.lit(0)))
                    spoke = total(lambda x: F.when(vote(x).isNotNull(), weight(x)).otherwise(0.0))
                    return (said_yes + held * believed[i]) / (spoke + held)
                return F.array(*[rate(i) for i in range(N_VOTES)])
            yes, no = (lambda x: x["y"]), (lambda x: x["n"] - x["y"])
            return F.struct(((total(yes) + 1.0) / (total(lambda x: x["n"]) + 2.0)).alias("prior"),
                            rates(yes, HIT).alias("hit"), rates(no, FALSE_ALARM).alias("miss"))
        return F.get(F.transform(F.array(F.transform("p", soft)), update), F.lit(0))

    return rows.select("kind", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step).alias("rates"))


def posterior(s: Column, v: Column) -> Column:
    """Probability that a span with votes ``v`` is personal data under the rates ``s``."""
    def loglik(rates):
        def term(i):
            vote, rate = F.get(v, F.lit(i)), F.get(rates, F.lit(i))
            return F.when(vote.isNull(), 0.0).when(vote == 1, F.log(rate)).otherwise(F.log(1.0 - rate))
        return sum((term(i) for i in range(N_VOTES)), F.lit(0.0))
    z = F.log(s["prior"]) - F.log(1.0 - s["prior"]) + loglik(s["hit"]) - loglik(s["miss"])
    return 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), z))))


def classify(voted: DataFrame, rates: DataFrame) -> DataFrame:
    """``voted`` with ``p``: the naive Bayes classifier trained on the EM labels.

    Feature values form a fixed, small set (a kind times at most 13 values each), so the table of
    weights is bounded by construction and travels as one row.
    """
    soft = voted.join(F.broadcast(rates), "kind").withColumn("y", posterior(F.col("rates"), F.col("votes")))   # at most one row per kind
    counts = soft.select(F.explode("feats").alias("f"), "y").groupBy("f").agg(F.sum("y").alias("a"), F.sum(1.0 - F.col("y")).alias("b"))
    prior = soft.groupBy("kind").agg(F.sum("y").alias("a"), F.sum(1.0 - F.col("y")).alias("b"))
    prior = prior.select(F.concat(F.lit("prior"), "kind").alias("f"), (F.log(F.col("a") + 1) - F.log(F.col("b") + 1)).alias("w"))
    # weight of a value: log odds against the kind's prior
    weights = (counts.withColumn("k", F.substring("f", 2, 1)).join(
        F.broadcast(prior.select(F.substring("f", 6, 1).alias("k"), F.col("w").alias("pw"))), "k")
        .select("f", (F.log(F.col("a") + 1) - F.log(F.col("b") + 1) - F.col("pw")).alias("w")))
    table = weights.unionByName(prior).agg(F.map_from_entries(F.collect_list(F.struct("f", "w"))).alias("t"))
    z = F.aggregate("feats", F.col("_t")[F.concat(F.lit("prior"), "kind")], lambda s, f: s + F.coalesce(F.col("_t")[f], F.lit(0.0)))
    return voted.withColumn("_t", table.scalar()).withColumn("p", 1.0 / (1.0 + F.exp(-z))).drop("_t")


def find_spans(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """doc_id, text_key, base, spans: arrays of struct<start, kind, end, kind name> per document.

    Positions are code points, end exclusive. ``spans`` holds the base spans and the accepted loose
    ones, ordered by start and then kind.

    Defined cases: null or empty text has no spans; rows that repeat both id and text are one
    document, an id with several texts has one row per text; a corpus without candidates has no
    estimates and no loose spans; an empty table gives no rows; other columns are ignored.
    """
    cands = cut(candidates(docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))))
    voted = votes(cands)
    scored = classify(voted, reliabilities(voted)).where(f"base or p >= {accept}")
    span = F.struct("start", "kind", "end")
    rows = (cands.select("doc_id", "text_key", F.lit(None).cast("struct<start:int,kind:int,end:int>").alias("b"),
                         F.lit(None).cast("struct<start:int,kind:int,end:int>").alias("l")).distinct()
            .unionByName(scored.select("doc_id", "text_key", F.when(F.col("base"), span).alias("b"), F.when(~F.col("base"), span).alias("l"))))
    got = rows.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("b")).alias("base"), F.collect_set("l").alias("_l"))
    free = F.filter("_l", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return got.select("doc_id", "text_key", "base", F.sort_array(F.concat("base", free)).alias("spans"))


def _listed(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def mask(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets (overlaps by the first one's)."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def put(s, x):
        skip = x["start"] < s["at"]
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"),
                        F.when(skip, s["out"]).otherwise(F.concat(s["out"], F.array(
                            F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.get(names, x["kind"])))).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(spans, start, put, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def op8_pii(spark, sf_dir):
    from kestrel.llm.common import table

    found = find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)],
                        F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("spans").alias("spans"))
