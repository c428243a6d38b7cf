"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base kinds (email, ip, card, phone) follow fixed patterns and always stay.
Looser patterns propose further candidates (phone numbers without a plus sign,
identity numbers, secrets). On every candidate three kinds of labelers vote: a
regex for its strict form, gazetteers of its value and of keys, and the words
around it. Expectation-maximisation over the counts of vote patterns estimates
how reliable each labeler is for each kind (a latent-class model); its posteriors
are the soft labels of a naive Bayes span classifier over votes, length and mix of
signs, whose decision per feature pattern is applied to the candidates. Secrets have at least 12 signs and may be of
any length: a run of their signs is walked once.

All of it is DataFrame expressions: positions of matches come from marking them
in the text, cutting at the marks and summing lengths. Spans are in code points,
end exclusive. Null texts have none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from newslens.llm.common import stored

# The base kinds in order. Possessive forms of the given patterns; a
# look-behind stands for the leftmost start, so a long run of signs is walked once.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
BASE_KINDS = ["email", "ip", "card", "phone"]

# Proposals of further spans and their strict forms
LOOSE = {
    "phone": r"(?<![0-9A-Za-z+().-])(?<!\+[0-9]{1,3} )(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "secret": r"(?<![0-9A-Za-z_+/-])(?=[A-Za-z_+/-]*+[0-9])[0-9A-Za-z_+/-]{12,}+",
}
STRICT = {
    "phone": r"^(\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}([ .-]))[2-9][0-9]{2}[ .-][0-9]{4}$",
    "id": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "secret": r"^(?=.*[0-9].*[0-9].*[0-9])(?:[0-9a-f]{12,}|[A-Z0-9]{16,}|(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z_+/-]{16,})$",
}
GAZETTEER = {  # known openings of values
    "phone": r"^\(?(?:202|212|213|305|312|404|415|503|617|702|713|800|888)\b",
    "id": r"^(?:00[1-9]|0[1-9][0-9]|[1-6][0-9]{2}|7[0-6][0-9]|77[0-2])-",
    "secret": r"^(?:AKIA|ASIA|ghp_|gho_|glpat-|xox[abp]-|sk-|sk_live_|pk_live_|AIza|ya29)",
}
CONTEXT = {  # words or keys right before a span
    "phone": r"(?i)\b(?:call|phone|tel|mobile|cell|fax|contact|whatsapp)\b[^0-9]{0,20}$",
    "id": r"(?i)\b(?:ssn|social security|id number|identity|tax id|passport)\b[^0-9]{0,20}$",
    "secret": r"(?i)\b(?:token|password|passwd|pwd|secret|api[_ -]?key|access[_ -]?key|auth|bearer)\b\W{0,6}$",
}
KINDS = [*BASE_KINDS, "id", "secret"]
VOTES = ("strict", "known", "near")
AROUND = 32        # signs before a candidate that the context labeler sees
ROUNDS = 20        # of expectation-maximisation
ACCEPT = 0.9       # probability from which a candidate becomes a span
_MARK, _OTHER = "\uE000", "\uE001"  # neither can be part of a match, so one may stand for the other
_CHUNK = 64


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, not again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _starts(sizes: Column) -> Column:
    """Running sums before each element, by way of the sums of whole chunks."""
    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0), lambda a, n: a + n)

    def steps(n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def run(s: Column) -> Column:
        chunks = F.transform(steps(F.ceil(F.size(s) / _CHUNK).cast("int")),
                             lambda c: total(F.slice(s, c * _CHUNK + 1, F.lit(_CHUNK))))
        return _with(chunks, lambda c: _with(
            F.transform(steps(F.size(c)), lambda i: total(F.slice(c, F.lit(1), i))),
            lambda before: F.transform(steps(F.size(s)), lambda i: F.get(before, F.floor(i / _CHUNK).cast("int"))
                                       + total(F.slice(s, F.floor(i / _CHUNK).cast("int") * _CHUNK + 1, i % _CHUNK)))))

    return _with(sizes, run)


def matches(text: Column, pattern: str, hint: Column) -> Column:
    """array<struct<at, end, value, before>> of all matches; ``text`` holds no mark.

    ``hint`` is a cheap test without which there is no match.
    """
    def cut(parts: Column) -> Column:
        return _with(_starts(F.transform(parts, lambda p: F.length(p))), lambda at: F.transform(
            F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: i % 2 == 1),
            lambda i: F.struct(F.get(at, i).alias("at"), (F.get(at, i) + F.length(F.get(parts, i))).alias("end"),
                               F.get(parts, i).alias("value"), F.right(F.get(parts, i - 1), F.lit(AROUND)).alias("before"))))

    marked = F.regexp_replace(text, pattern, _MARK + "$0" + _MARK)
    none = F.array().cast("array<struct<at:int,end:int,value:string,before:string>>")
    return F.when(hint, _with(F.split(marked, _MARK), lambda p: F.when(F.size(p) > 1, cut(p)).otherwise(none))).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The check sum of a number of ASCII digits holds."""
    def one(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    steps = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(steps, one), F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Matches of each base kind that pass its check."""
    number = text.rlike("[0-9]")
    small = lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3
    return {
        "email": matches(text, EMAIL, text.contains("@")),
        "ip": F.filter(matches(text, IP, text.contains(".") & number), lambda m: F.forall(
            F.split(m["value"], r"\."), lambda p: small(p) & F.when(
                small(p), F.right(p, F.lit(3)).cast("int") <= 255).otherwise(False))),
        "card": F.filter(matches(text, CARD, number), lambda m: luhn(_digits(m["value"]))),
        "phone": F.filter(matches(text, PHONE, text.contains("+")), lambda m: F.length(_digits(m["value"])).between(8, 15)),
    }


def candidates(text: Column) -> Column:
    """Proposed spans with their votes and features."""
    number = {"phone": text.rlike("[0-9]{4}"), "id": text.rlike("-[0-9]{4}"), "secret": text.rlike("[0-9]")}

    def judged(kind: str) -> Column:
        def span(m: Column) -> Column:
            v = m["value"]
            return F.struct(
                F.lit(kind).alias("kind"), m["at"].alias("at"), m["end"].alias("end"),
                v.rlike(STRICT[kind]).cast("int").alias("strict"), v.rlike(GAZETTEER[kind]).cast("int").alias("known"),
                m["before"].rlike(CONTEXT[kind]).cast("int").alias("near"),
                F.least(F.lit(4), F.floor(F.length(v) / 10)).cast("int").alias("size"),
                F.floor(4 * F.length(_digits(v)) / F.length(v)).cast("int").alias("digits"))
        return F.transform(matches(text, LOOSE[kind], number[kind]), span)

    return F.concat(*[judged(k) for k in LOOSE])


def _posterior(rates: Column, votes: Column) -> Column:
    """Probability of personal data, given the rates of a kind's labelers and their votes."""
    like = {1: rates["prior"], 0: 1 - rates["prior"]}
    for v in VOTES:
        for z in (0, 1):
            like[z] = like[z] * F.when(votes[v] == 1, rates[f"{v}_{z}"]).otherwise(1 - rates[f"{v}_{z}"])
    return like[1] / (like[0] + like[1])


def reliabilities(patterns: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``patterns`` (kind, votes, features, n) with the posterior ``p`` of being personal data.

    Latent classes for each kind: every labeler votes by its own rates given the
    truth. Starts from rates that trust the labelers. The patterns are bounded by
    the kinds and features, so they stand in one array, and all rounds are one
    fold over it.
    """
    def rates_of(kind: Column, prior: Column, of: Callable[[str, int], Column]) -> Column:
        return F.struct(kind.alias("kind"), prior.cast("double").alias("prior"),
                        *[of(v, z).cast("double").alias(f"{v}_{z}") for v in VOTES for z in (0, 1)])

    def refit(rates: Column) -> Column:
        """One round for one kind: expected votes, then new rates."""
        def add(sums: Column, x: Column) -> Column:
            return _with(_posterior(rates, x), lambda p: rates_of(
                sums["kind"], sums["prior"] + x["n"] * p, lambda v, z: sums[f"{v}_{z}"] + x[v] * x["n"] * (p if z else 1 - p)))

        own = F.filter("patterns", lambda x: x["kind"] == rates["kind"])
        n = F.aggregate(own, F.lit(0.0), lambda a, x: a + x["n"])
        zero = rates_of(rates["kind"], F.lit(0.0), lambda v, z: F.lit(0.0))
        return _with(F.struct(F.aggregate(own, zero, add).alias("s"), n.alias("n")), lambda x: rates_of(
            x["s"]["kind"], (x["s"]["prior"] + 1) / (x["n"] + 2), lambda v, z: (x["s"][f"{v}_{z}"] + 0.5) / (
                (x["s"]["prior"] if z else x["n"] - x["s"]["prior"]) + 1)))

    start = F.array(*[rates_of(F.lit(k), F.lit(0.5), lambda v, z: F.lit(0.9 if z else 0.1)) for k in LOOSE])
    packed = patterns.agg(F.collect_list(F.struct(
        "kind", *VOTES, F.col("n").cast("double").alias("n"))).alias("patterns"))
    fitted = packed.select(F.explode(F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), start, lambda rates, _: F.transform(rates, refit))).alias("rates")).select("rates.*")
    # one line per kind beside a pattern table that the features bound
    joined = patterns.join(F.broadcast(fitted), "kind")
    rates = {c: F.col(c) for c in fitted.columns}
    return stored(joined.select(*patterns.columns, _posterior(rates, {v: F.col(v) for v in VOTES}).alias("p")), "posteriors")


FEATURES = (*VOTES, "size", "digits")


def classifier(posteriors: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(pattern, yes): naive Bayes over all features, fitted to the soft labels, for every pattern seen."""
    long_ = posteriors.select("kind", "n", "p", F.explode(F.array(*[
        F.struct(F.lit(f).alias("f"), F.col(f).alias("x")) for f in FEATURES])).alias("t")).select("kind", "n", "p", "t.*")
    total = posteriors.groupBy("kind").agg(
        F.sum(F.col("n") * F.col("p")).alias("t1"), F.sum(F.col("n") * (1 - F.col("p"))).alias("t0"))
    each = long_.groupBy("kind", "f", "x").agg(
        F.sum(F.col("n") * F.col("p")).alias("n1"), F.sum(F.col("n") * (1 - F.col("p"))).alias("n0"))
    weight = each.join(F.broadcast(total), "kind").select("kind", "f", "x", F.log(
        ((F.col("n1") + 0.5) / (F.col("t1") + 2.5)) / ((F.col("n0") + 0.5) / (F.col("t0") + 2.5))).alias("w"))
    keyed = posteriors.select("kind", *FEATURES, pattern_key(lambda f: F.col(f)).alias("pattern"))
    lines = keyed.select("kind", "pattern", F.explode(F.array(*[
        F.struct(F.lit(f).alias("f"), F.col(f).alias("x")) for f in FEATURES])).alias("t")).select("kind", "pattern", "t.*")
    odds = lines.join(F.broadcast(weight), ["kind", "f", "x"]).groupBy("kind", "pattern").agg(F.sum("w").alias("w"))
    odds = odds.join(F.broadcast(total), "kind").withColumn("w", F.col("w") + F.log((F.col("t1") + 1) / (F.col("t0") + 1)))
    return odds.select("pattern", (1 / (1 + F.exp(-F.col("w"))) >= accept).alias("yes"))


def pattern_key(of: Callable[[str], Column]) -> Column:
    return F.concat_ws(":", *[of(f).cast("string") for f in ("kind", *FEATURES)])


def find_pii(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, spans, added) for every row of ``docs``: the base spans in order of kind
    and start, and those that the classifier adds, arrays of (kind, at, end)."""
    text = F.replace(F.coalesce("text", F.lit("")), F.lit(_MARK), F.lit(_OTHER))
    clean = docs.select("doc_id", text.alias("text"))
    kinds = base_spans(F.col("text"))

    def named(kind: str) -> Column:
        return F.transform(kinds[kind], lambda m: F.struct(
            F.lit(kind).alias("kind"), m["at"].alias("at"), m["end"].alias("end")))

    base = F.concat(*[named(k) for k in BASE_KINDS])
    found = stored(clean.select("doc_id", base.alias("spans"), candidates(F.col("text")).alias("proposed")), "spans")
    # patterns: three kinds times the values of the features, whatever the corpus
    patterns = stored(found.where(F.size("proposed") > 0).select(F.explode("proposed").alias("c")).select(
        "c.kind", *[f"c.{f}" for f in FEATURES]).groupBy("kind", *FEATURES).agg(F.count("*").alias("n")), "vote-patterns")
    chosen = classifier(reliabilities(patterns), accept).where("yes").agg(
        F.coalesce(F.collect_list("pattern"), F.array().cast("array<string>")).alias("patterns"))
    found = found.withColumn("accepted", stored(chosen, "accepted").scalar())
    overlaps = lambda c: F.exists("spans", lambda s: (s["at"] < c["end"]) & (c["at"] < s["end"]))
    added = F.filter("proposed", lambda c: F.array_contains("accepted", pattern_key(lambda f: c[f])))
    added = F.transform(F.filter(added, lambda c: ~overlaps(c)), lambda c: F.struct(
        c["kind"].alias("kind"), c["at"].alias("at"), c["end"].alias("end")))
    return found.select("doc_id", "spans", added.alias("added"))


def listing(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["at"].cast("string"), s["end"].cast("string"))), ",")


def summary(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans in order of kind and start."""
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    everything = F.array_sort(F.transform(F.concat("spans", "added"), lambda s: F.struct(
        order[s["kind"]].alias("no"), s["at"].alias("at"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(listing(F.col("spans")), 256).alias("base_sha256"), listing(everything).alias("spans"))
