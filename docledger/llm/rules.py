"""Quality rules by weak supervision: rules vote or abstain, and a label model weighs them.

Each rule looks at a statistic of its own and votes good (+1), bad (-1) or abstains (0).  None of them is
sure: each may vote bad on good texts.  Expectation-maximisation over the counts of vote patterns estimates, for
every rule, how often its votes are right on good and on bad texts, and the share of good texts; it starts from
the share of good votes of each pattern and a weak prior that is the same for all rules.  A text is kept if the
posterior probability of good is at least `threshold`, so a bad vote of a rule that turns out to tell nothing
doesn't cost a text, and one of a rule that is always right does.
The patterns are counted over all texts (a map-side combined count with at most 3^rules groups), so EM
needs no more than that small table whatever the input.

Two hard base rules come first: fewer than 50 words, or more than half of the words inside repeated
three-word windows; texts that fail them are not learned from.  Null text: no words, so it fails the base.
Repeated rows: one result each.  Empty tables: an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docledger.llm.shared import each, give_back, text_bytes
from docledger.llm.textstats import TextStats, text_stats


def _vote(value: float, good: tuple[float, float], bad: tuple[float, float]) -> int:
    """+1 within `good`, -1 outside `bad`, else 0."""
    return 1 if good[0] <= value <= good[1] else 0 if bad[0] < value < bad[1] else -1


_FAR = float("inf")


def votes(s: TextStats) -> tuple[int, ...]:
    n, letters = max(1, s.n_words), max(1, s.n_upper + s.n_lower)
    repeated = max(s.n_dup_lines / max(1, s.n_lines), s.n_repeat_words / n)
    return (
        _vote(s.n_words, (100, _FAR), (75, _FAR)),
        _vote(s.word_chars / n, (3.5, 6.5), (3, 7.2)),
        _vote(s.n_symbols / n, (0, 0.02), (-1, 0.1)),
        _vote(repeated, (0, 0.02), (-1, 0.08)),
        _vote(s.n_upper / letters, (0.003, 0.1), (0, 0.3)),
        _vote(s.n_exclaim / n, (0, 0.01), (-1, 0.1)),
        _vote(s.n_top / n, (0, 0.1), (-1, 0.2)),
        _vote(s.n_adjacent / n, (0, 0.01), (-1, 0.03)),
        _vote(s.n_digits / max(1, s.word_chars), (0, 0.02), (-1, 0.1)),
    )


N_RULES = 9
#: The pattern of texts that fail the base.
FAILED = -1


def encoded(v: tuple[int, ...]) -> int:
    code = 0
    for x in v:
        code = code * 3 + x + 1
    return code


def decoded(code: int) -> tuple[int, ...]:
    out = []
    for _ in range(N_RULES):
        code, digit = divmod(code, 3)
        out.append(digit - 1)
    return tuple(reversed(out))


def base_failed(s: TextStats) -> bool:
    return s.n_words < 50 or 100 * s.n_repeat_words > 50 * s.n_words


def pattern(s: TextStats) -> int:
    return FAILED if base_failed(s) else encoded(votes(s))


@F.arrow_udf(T.IntegerType())
def vote_pattern(text: pa.Array) -> pa.Array:
    out = pa.array([pattern(text_stats(t)) for t in each(text)], pa.int32())
    give_back()
    return out


def pattern_counts(documents: DataFrame, text_col="text") -> dict[int, int]:
    rows = documents.select(vote_pattern(text_bytes(text_col)).alias("pattern")).where(F.col("pattern") != FAILED).groupBy("pattern").count().collect()
    return {r.pattern: r["count"] for r in rows}


def fit_label_model(counts: dict[int, int], rounds: int = 500, share: float = 0.005, least: float = 4.0, accuracy: float = 0.75) -> dict[int, float]:
    """Posterior probability of good, by vote pattern.

    A rule that votes is right with a probability of its own in each class; one that abstains says
    nothing.  The prior is pseudo-votes of that `accuracy` for every rule in either class, and as many pseudo-texts,
    half of them good.  Their number is `share` of the texts (`least` at least), so that they weigh alike whatever the size
    of the corpus: where there are no bad texts, the second class stays what the prior says instead of fitting to some
    usual trait of good ones, as being short.
    """
    if not counts:
        return {}
    patterns, strength = sorted(counts), max(least, share * sum(counts.values()))
    v = np.array([decoded(p) for p in patterns])
    n = np.array([counts[p] for p in patterns], float)
    says_bad, says_good = (v == -1).astype(float), (v == 1).astype(float)
    good = (says_good.sum(1) + 1) / (says_good.sum(1) + says_bad.sum(1) + 2)
    for _ in range(rounds):
        share = (n @ good + 0.5 * strength) / (n.sum() + strength)
        logs = []
        for weight, part, prior in ((n * (1 - good), 1 - share, accuracy), (n * good, share, 1 - accuracy)):
            bad = weight @ says_bad + strength * prior
            bad /= weight @ (says_bad + says_good) + strength
            logs.append(np.log(part) + says_bad @ np.log(bad) + says_good @ np.log(1 - bad))
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    return dict(zip(patterns, map(float, good)))


_FIELDS = "n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, n_repeat_words: bigint, base_failed: boolean, kept: boolean, p_good: double"


def verdicts(posterior: dict[int, float], threshold: float):
    names = [x.split(":")[0].strip() for x in _FIELDS.split(",")]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]

    @F.arrow_udf(f"struct<{_FIELDS}>")
    def judged(text: pa.Array) -> pa.Array:
        rows = []
        for t in each(text):
            s = text_stats(t)
            failed, p = base_failed(s), posterior.get(pattern(s), 0.0)
            rows.append((*s[:5], failed, not failed and p >= threshold, p))
        give_back()
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return judged


def judge_rules(documents: DataFrame, id_col="doc_id", text_col="text", threshold=0.5) -> DataFrame:
    """id, the base counts, base_failed, kept, p_good; a row for each row."""
    judged = verdicts(fit_label_model(pattern_counts(documents, text_col)), threshold)
    return documents.select(F.col(id_col), judged(text_bytes(text_col)).alias("v")).select(id_col, "v.*")


def keep_by_rules(documents: DataFrame, text_col="text", threshold=0.5) -> DataFrame:
    """The rows, whole and unchanged, that the rules keep."""
    judged = verdicts(fit_label_model(pattern_counts(documents, text_col)), threshold)
    return documents.where(judged(text_bytes(text_col)).getField("kept"))
