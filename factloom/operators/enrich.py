"""Model requests and stored responses.

No model client is included. A request table is built from the articles;
requests already answered are skipped by an anti-join on ``request_id``;
the rest go through a user-supplied, pure ``responder`` inside
``mapInPandas`` (one Arrow batch at a time, on the executors); answers are
appended to a response table keyed by ``request_id`` so a retried task or a
re-run never asks twice for the same thing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import MAX_REQUEST_WORDS, PROMPT_CATEGORIES, PROJECT_FIELDS
from ..functions.text import trim_to_words, ustrip
from .answers import ask_stored, distinct_prompts, unanswered

RESPONSE_SCHEMA = ("request_id string, doc_id string, stage string, raw string, ok boolean, attempts int, "
                   "answered_at timestamp")

# Request templates; ``{text}`` is replaced by the (trimmed) input text.
SUMMARY_TEMPLATE = (
    "List every construction project in the text below as a numbered list; for each give its "
    "location, what is being built, who funds it, the money spent, its category, the expected "
    "completion date and a short note. Answer 'none' when there is no project.\n{text}")
FIELDS_TEMPLATE = (
    "For each numbered project below return one Python dict with the keys "
    + ", ".join(f"'{alts[0]}'" for _, alts in PROJECT_FIELDS)
    + ". Use one of these categories: " + "; ".join(PROMPT_CATEGORIES) + ".\n{text}")
USD_TEMPLATE = "Return the amount of money below in U.S. dollars as a quoted number, or 0.\n{text}"
RELEVANCE_TEMPLATE = "Does the text below describe construction in Iraq? Answer yes or no.\n{text}"


def request_text(text: Column, stage: str, template: str, max_words: int = MAX_REQUEST_WORDS) -> Column:
    """T12 + T13: ``stage`` line + template around the text cut to ``max_words``."""
    pre, _, post = template.partition("{text}")
    return F.concat(F.lit(stage + "\n" + pre), trim_to_words(text, max_words), F.lit(post))


def build_requests(df: DataFrame, id_col: str, text_col: str, stage: str, template: str,
                   max_words: int = MAX_REQUEST_WORDS) -> DataFrame:
    """Request table ``(request_id, doc_id, stage, prompt)``; id = sha2 of the prompt."""
    prompt = request_text(F.col(text_col), stage, template, max_words)
    return (df.filter(F.col(text_col).isNotNull())
            .select(F.col(id_col).cast("string").alias("doc_id"), F.lit(stage).alias("stage"),
                    prompt.alias("prompt"))
            .withColumn("request_id", F.sha2(F.col("prompt"), 256))
            .select("request_id", "doc_id", "stage", "prompt"))


def prefer_full_text(df: DataFrame, full_col: str = "full_content", text_col: str = "content") -> Column:
    """Full text when present and not empty, else the content."""
    if full_col not in df.columns:
        return F.col(text_col)
    return F.coalesce(F.nullif(F.col(full_col), F.lit("")), F.col(text_col))


def pending(requests: DataFrame, responses: DataFrame | None) -> DataFrame:
    """Requests without a good answer yet; see ``answers.unanswered``."""
    return unanswered(requests, responses)


class ResponderStopped(BaseException):
    """Raised by a responder that cannot go on at all (quota used up, key refused): the run ends, nothing is retried."""


def ask(responder: Callable[[pd.Series], pd.Series], prompts: pd.Series) -> pd.Series:
    """Replies to ``prompts``; where a call fails, its prompts are asked in halves, so that one bad
    prompt costs its own reply only (None)."""
    try:
        return pd.Series(list(responder(prompts)), index=prompts.index, dtype=object)
    except Exception:  # noqa: BLE001 - a prompt that fails alone has no reply
        if len(prompts) == 1:
            return pd.Series([None], index=prompts.index, dtype=object)
        half = len(prompts) // 2
        return pd.concat([ask(responder, prompts.iloc[:half]), ask(responder, prompts.iloc[half:])])


def reply_batches(prompts: DataFrame, responder: Callable[[pd.Series], pd.Series], retries: int = 3, answered_at=None) -> DataFrame:
    """One answer row per row of ``(request_id, stage, prompt)``, an Arrow batch at a time; prompts that fail are asked
    up to ``retries`` times and come back with ``ok = false``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            raw = pd.Series([None] * len(b), index=b.index, dtype=object)
            attempts = pd.Series(0, index=b.index, dtype="int32")
            for _ in range(retries):
                todo = raw.isna()
                if not todo.any():
                    break
                attempts[todo] += 1
                raw[todo] = ask(responder, b.loc[todo, "prompt"])
            yield pd.DataFrame({"request_id": b["request_id"], "stage": b["stage"], "raw": raw,
                                "ok": raw.notna(), "attempts": attempts})
    answers = prompts.mapInPandas(run, "request_id string, stage string, raw string, ok boolean, attempts int")
    return answers.withColumn("answered_at", F.current_timestamp() if answered_at is None else answered_at)


def run_responder(requests: DataFrame, responder: Callable[[pd.Series], pd.Series],
                  retries: int = 3, materialize: bool = True, answered_at=None, store: str | None = None) -> DataFrame:
    """Answer requests with ``responder`` (prompts -> replies, None = failed).

    Each distinct prompt (``request_id``) is asked once, however many rows
    share it; the answer is joined back to every requesting row. With
    ``store`` (a shared folder) answers are kept chunk by chunk as they
    arrive, what the store knows is not asked, and a run that was killed
    goes on where it stopped (``answers.ask_stored``). Without it the
    answers are materialised once in the shared checkpoint folder, so later
    uses (accepting, attaching, writing) never ask the model again.
    ``answered_at`` (a timestamp column, default now) marks the run.
    """
    if store:
        answers = ask_stored(requests, responder, store, retries=retries, answered_at=answered_at)
    else:
        answers = reply_batches(distinct_prompts(requests), responder, retries, answered_at)
        if materialize:
            from ..session import cut_lineage
            answers = cut_lineage(answers)
    out = requests.select("request_id", "doc_id").join(answers, "request_id")
    return out.select("request_id", "doc_id", "stage", "raw", "ok", "attempts", "answered_at")


def strip_reply(col: str = "raw") -> Column:
    """T14."""
    return ustrip(F.col(col))


def accepted(responses: DataFrame) -> DataFrame:
    """Summaries that start with ``1`` (a numbered list)."""
    return responses.filter(F.col("ok") & F.col("raw").startswith("1"))


def attach_responses(df: DataFrame, responses: DataFrame, requests: DataFrame, id_col: str,
                     out_col: str = "summaries") -> DataFrame:
    """The latest good answer to each row's own request, plus ``performed``.

    ``requests`` is the request table of ``df`` (``build_requests``): answers
    belong to prompts, so a row whose prompt was answered for another
    document, or on another day, gets that answer too. Rows without a
    request (null text) and rows whose request has no good answer get null.
    """
    good = responses.filter("ok").groupBy("request_id").agg(F.max(F.struct("answered_at", "raw")).alias("_good"))
    # a row with two requests gets the later answer
    mine = (requests.select(F.col("doc_id").alias("_id"), "request_id").distinct().join(good, "request_id")
            .groupBy("_id").agg(F.max("_good").alias("_good")).select("_id", F.col("_good.raw").alias(out_col)))
    j = df.join(mine, df[id_col].cast("string") == mine["_id"], "left").drop("_id")
    return j.withColumn("performed", F.col(out_col).isNotNull())


def all_performed(df: DataFrame, col: str = "performed") -> bool:
    """Every row has been answered."""
    return bool(df.agg(F.coalesce(F.bool_and(F.col(col)), F.lit(True))).first()[0])


def is_relevant(check_col: str = "content_check") -> Column:
    """E2 + P8: the relevance answer contains "yes" (any case); null = no."""
    return F.coalesce(F.lower(F.col(check_col)).contains("yes"), F.lit(False))


def usd_by_model(rows: DataFrame, responder: Callable[[pd.Series], pd.Series], id_col: str,
                 amount_col: str = "amount_text", responses: DataFrame | None = None,
                 store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """USD by model: ask for the amount in dollars, read the reply with M1.

    Returns ``(rows + usd, new responses)``; pass yesterday's response table
    as ``responses``, or the folder answers are kept in as ``store``, and only
    amounts never asked about are sent.
    """
    from ..functions.money import usd_or_zero
    req = build_requests(rows, id_col, amount_col, "usd", USD_TEMPLATE)
    new = run_responder(pending(req, responses), responder, store=store)
    answered = new if responses is None else responses.unionByName(new)
    out = attach_responses(rows, answered, req, id_col, out_col="usd_reply").drop("performed")
    return out.withColumn("usd", usd_or_zero(strip_reply("usd_reply"))), new


def relevance(rows: DataFrame, responder: Callable[[pd.Series], pd.Series], id_col: str,
              text_col: str = "content", responses: DataFrame | None = None,
              store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """E2 + P8: ask whether each row is relevant; keep the rows answered "yes".

    Returns ``(relevant rows with content_check, new responses)``.
    """
    req = build_requests(rows, id_col, text_col, "relevance", RELEVANCE_TEMPLATE)
    new = run_responder(pending(req, responses), responder, store=store)
    answered = new if responses is None else responses.unionByName(new)
    out = attach_responses(rows, answered, req, id_col, out_col="content_check")
    return out.filter(is_relevant("content_check")).drop("performed"), new


def summaries(rows: DataFrame, responder: Callable[[pd.Series], pd.Series], id_col: str, text_col: str = "content",
              full_col: str = "full_content", responses: DataFrame | None = None,
              store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Two-stage summaries of each row, as ``summaries`` (null = not performed).

    The full text where present, else the content (P15), cut to the first
    12,000 words (T12), is asked for a numbered list (T13); lists that start
    with 1 are accepted (P13) and asked for one dict per project. Answers
    stored in ``responses`` or in the folder ``store`` are used and not asked
    for again (P12, J7); with ``store`` a run that was killed goes on where it
    stopped, in either stage.
    Returns ``(rows + summaries + performed, new responses of both stages)``.
    """
    first = build_requests(rows.withColumn("_text", prefer_full_text(rows, full_col, text_col)), id_col, "_text", "summaries", SUMMARY_TEMPLATE)
    new_first = run_responder(pending(first, responses), responder, store=store)
    known = new_first if responses is None else responses.unionByName(new_first)
    listed = attach_responses(rows.select(id_col), known, first, id_col, out_col="raw").filter(F.col("raw").startswith("1"))
    second = build_requests(listed, id_col, "raw", "fields", FIELDS_TEMPLATE)
    new_second = run_responder(pending(second, responses), responder, store=store)
    known = new_second if responses is None else responses.unionByName(new_second)
    return attach_responses(rows, known, second, id_col, out_col="summaries"), new_first.unionByName(new_second)
