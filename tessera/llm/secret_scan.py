"""Secret scan through a trigram inverted index, in DataFrame functions only.

Each rule's regex yields a Boolean trigram query: an OR of clauses, each clause the AND of the
trigrams of a literal that every match of that branch must contain. Postings (trigram, document)
are kept for the trigrams that the queries name; a clause's postings are intersected by counting
its trigrams per document; documents that satisfy a clause are the rule's candidates and are
verified by the regex. A rule without mandatory trigrams scans every text.

Positions come from the regex alone: ``split`` gives the pieces between matches and
``regexp_extract_all`` the matches, so the running sum of their lengths is where matches start.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, prepare, scratch, text_hash, text_or_empty, with_row_key


@dataclass(frozen=True)
class Rule:
    """``literals``: each a case-folded literal of one branch; every match contains one of them.
    ``group`` is the regex group whose length must reach ``least`` code points."""

    kind: str
    regex: str
    literals: tuple[str, ...] = ()
    group: int = 0
    least: int = 0

    def clauses(self) -> list[frozenset[str]]:
        """The Boolean query in disjunctive form; empty if a branch has no trigram."""
        out = [frozenset(x[i : i + 3] for i in range(len(x) - 2)) for x in self.literals]
        return out if all(out) else []


#: Fixed by the task: the base kinds, in their order.
BASE = (
    Rule("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", ("password", "passwd", "secret", "token", "api_key", "apikey"), 1, 8),
    Rule("access", r"AKIA[A-Z0-9]+", ("akia",), 0, 16),
    Rule("hex", r"[0-9a-f]+", (), 0, 32),
)

#: What the scan adds to the base kinds: well-known credential formats.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", ("private key-----",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", ("eyj",)),
    Rule("vcs", r"gh[opsu]_[A-Za-z0-9]{36,}", ("gho_", "ghp_", "ghs_", "ghu_")),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-")),
    Rule("bearer", r"[bB]earer [A-Za-z0-9._~+/-]{20,}=*", ("bearer ",)),
)


def scan_regex(rule: Rule) -> str:
    """Same accepted matches as ``rule.regex`` but without its many short failing ones, where
    the match is one run of a class, so a short run can never hide a later match."""
    if rule.group == 0 and rule.least and rule.regex.endswith("]+"):
        fixed = len(rule.regex[: rule.regex.index("[")])
        return f"{rule.regex[:-1]}{{{rule.least - fixed},}}"
    return rule.regex


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches in order, as structs (rank, pos, gap before it, size, checked size)."""
    regex = scan_regex(rule)
    found = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(regex), F.lit(rule.group))
    rows = F.arrays_zip(F.slice(F.split(text, regex, -1), 1, F.size(found)).alias("gap"), found.alias("all"), checked.alias("part"))
    return F.transform(
        rows,
        lambda r, i: F.struct(F.lit(rank).alias("rank"), i.alias("pos"), F.length(r["gap"]).alias("gap"), F.length(r["all"]).alias("size"), F.length(r["part"]).alias("part")),
    )


def posting_index(rows: DataFrame, rules: tuple[Rule, ...], text_col: str = "_text") -> DataFrame:
    """``(ROW, trigram)`` for the trigrams that the rules' queries name, on case-folded text."""
    wanted = sorted({t for r in rules for c in r.clauses() for t in c})
    folded = rows.select(*ROW, F.lower(F.col(text_col)).alias("folded"))
    hits = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in wanted]))
    return folded.select(*ROW, F.explode(hits).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Intersect postings: ``(ROW, kinds)``, the rules with a clause whose trigrams are all there."""
    # the clause table is as large as the rules, a parameter: it is part of the plan. Repeated rows
    # repeat their postings, which can only add candidates, and those are verified.
    clauses = [(r.kind, i, len(c), t) for r in rules for i, c in enumerate(r.clauses()) for t in sorted(c)]
    table = index.sparkSession.createDataFrame(clauses, "kind string, clause int, need int, trigram string")
    met = index.join(F.broadcast(table), "trigram").groupBy(*ROW, "kind", "clause", "need").agg(F.count("*").alias("got")).where("got >= need")
    return met.groupBy(*ROW).agg(F.collect_set("kind").alias("kinds"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``(id, found)`` for every row: ``found`` is the array of (start, rank, kind, end) in order, in
    code points, end exclusive; ``rank`` is the rule's place in ``rules``.

    A null or empty text has no spans; a null id is returned as such; repeated rows repeat;
    an empty table gives an empty one; other columns are not read.
    """
    prepare(docs.sparkSession)
    rows = with_row_key(docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("_text")), "id", text_hash("_text"))
    index = scratch(posting_index(rows, rules), "trigrams")
    placed = rows.select(*ROW, "_text").join(candidates(index, rules), ROW, "left")
    text, none = F.col("_text"), F.array().cast("array<struct<rank:int,pos:int,gap:int,size:int,part:int>>")

    def verified(rank: int, rule: Rule) -> Column:
        asked = F.array_contains("kinds", rule.kind) if rule.clauses() else F.lit(True)
        return F.when(asked & F.rlike(text, F.lit(scan_regex(rule))), matches(text, rule, rank)).otherwise(none)

    # from here on only matches, one row each; repeated rows give the same ones
    hits = placed.select(*ROW, F.explode(F.concat(*[verified(i, r) for i, r in enumerate(rules)])).alias("m")).select(*ROW, "m.*")
    once = hits.repartition(*ROW).dropDuplicates([*ROW, "rank", "pos"])
    walk = Window.partitionBy(*ROW, "rank").orderBy("pos")
    end = F.sum(F.col("gap") + F.col("size")).over(walk).cast("int")
    kinds, least = F.array(*[F.lit(r.kind) for r in rules]), F.array(*[F.lit(r.least) for r in rules])
    accepted = once.withColumn("end", end).where(F.col("part") >= least[F.col("rank")])
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "rank", kinds[F.col("rank")].alias("kind"), "end")
    found = accepted.groupBy(*ROW).agg(F.array_sort(F.collect_list(span)).alias("found"))
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    return rows.select("id", *ROW).join(found, ROW, "left").select("id", F.coalesce("found", empty).alias("found"))


def span_text(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
