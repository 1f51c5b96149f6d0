"""URL filter: host rules first, then a weighted vocabulary counted with an Aho-Corasick automaton.

A rule is (host, path prefix, verdict) and fits its host and all subdomains if the URL's path starts with
the rule's; the longest rule that fits decides. Any other URL is judged by its words: an automaton finds all
terms of the vocabulary in one pass over the lower-cased URL, hits inside a longer run of letters or digits
do not count, and the weights of the *distinct* terms hit are added. A strict term weighs as much as the
limit, so one suffices; soft terms weigh less, so several are needed.

Defined results: a NULL URL or one without ``://`` has an empty host and path and no rule; a NULL or empty URL
hits no term and is allowed; repeated rows are judged alike; URLs of any length are read whole; an empty table gives no rows, an empty vocabulary no hits; all
input columns but the result's own stay out.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.llm.rows import bound_batches, lower_ascii

#: A URL is blocked from this weight on: by one strict term, two strong soft ones, or weak ones that add up to it.
LIMIT = 4
MOST_TERMS = 500_000
WORDY = frozenset(string.ascii_lowercase + string.digits)
STRICT = "porn porno xxx nsfw hentai camgirls milf adult warez keygen pornos porno-gratis sexfilme"
STRONG = (
    "casino win bet bets betting poker slots jackpot lottery roulette bingo viagra cialis pills pharma sex sexy dating escort nude "
    "cam crack cracked hack cheat loan payday replica spam farm "
    "wetten gluecksspiel spielautomat erotik potenzmittel rezeptfrei sofortkredit raubkopie "
    "loterie pilules erotique rencontres escorte contrefacon pari-sportif "
    "apuestas tragamonedas loteria ruleta pastillas erotico citas prestamos"
)
WEAK = "free bonus deal deals cheap coupon ads track tracker gratis gratuit kostenlos billig barato oferta rabatt promo"
VOCABULARY = {
    **dict.fromkeys(STRICT.split(), LIMIT), **dict.fromkeys(STRONG.split(), 2), **dict.fromkeys(WEAK.split(), 1)
}
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def read_vocabulary(terms: DataFrame) -> dict[str, int]:
    """A vocabulary from a table (term, weight): lower-cased, the larger weight counts. At most ``MOST_TERMS`` terms."""
    kept = terms.where("term <> '' and weight > 0").groupBy(lower_ascii(F.col("term")).alias("term")).agg(F.max("weight").alias("w"))
    rows = kept.limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    return {r.term: int(r.w) for r in rows}


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, NULL if none does. ``rules`` is a short parameter list."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        hit = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, hit).otherwise(found)
    return found


def hits_in(url: str, automaton: ahocorasick.Automaton) -> set[str]:
    """The distinct terms of the automaton in ``url`` with no ASCII letter or digit on either side."""
    found = set()
    for end, term in automaton.iter(url):
        start = end - len(term)
        if start >= 0 and url[start] in WORDY or end + 1 < len(url) and url[end + 1] in WORDY:
            continue
        found.add(term)
    return found


def term_hits(url: Column, vocabulary: Mapping[str, int], limit: int) -> Column:
    """Struct (strict, soft, weight): distinct strict and soft terms hit, and the weight of all of them."""
    weights = dict(vocabulary)

    @F.pandas_udf("strict int, soft int, weight int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for term in weights:
            automaton.add_word(term, term)
        automaton.make_automaton()
        for urls in batches:
            rows = []
            for url in urls:
                found = [weights[t] for t in hits_in(url, automaton)] if url and weights else []
                strict = sum(w >= limit for w in found)
                rows.append((strict, len(found) - strict, sum(found)))
            yield pd.DataFrame(rows, columns=["strict", "soft", "weight"], dtype="int32")

    return count(lower_ascii(url))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    vocabulary: Mapping[str, int] | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, strict_hits, soft_hits, weight, verdict."""
    bound_batches(pages.sparkSession)
    parts = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = parts.withColumns(
        {
            "fit": match_rule(F.col("host"), F.col("path"), rules),
            "hits": term_hits(F.col("url"), VOCABULARY if vocabulary is None else vocabulary, limit),
        }
    )
    by_words = F.when(F.col("hits.weight") >= limit, "block").otherwise("allow")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.col("hits.strict").alias("strict_hits"),
        F.col("hits.soft").alias("soft_hits"),
        F.col("hits.weight").alias("weight"),
        F.coalesce(F.col("fit.verdict"), by_words).alias("verdict"),
    )
