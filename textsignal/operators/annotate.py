"""Labelling of passages by a caller's model, and reading its replies."""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed
from textsignal.functions import replies
from textsignal.functions.text import letters_only

# Prompts and budgets of a batch in, one reply per prompt out; None where the model failed.
Scorer = Callable[[Sequence[str], Sequence[int]], Sequence[str | None]]

#: Errors of the scorer's own code: asking again can't help.
MISTAKES = (TypeError, NameError, AttributeError, ImportError, SyntaxError, AssertionError)
#: One error so many times in a row ends the job, whatever `max_attempts` is.
SAME_ERRORS = 1_000
#: Seconds that a pause between attempts grows to.
LONGEST_PAUSE = 60.0
#: Prompts whose replies are committed together.
COMMIT_ROWS = 64


def build_prompts(
    df: DataFrame, text: str, instruction: str, reserve: int = fixed.PROMPT_RESERVE
) -> DataFrame:
    """Adds `prompt`, made of the letters-only text, and its `budget` of words."""
    prompted = df.withColumn("prompt", replies.prompt(letters_only(F.col(text)), instruction))
    return prompted.withColumn("budget", replies.token_budget(F.col("prompt"), reserve))


def annotate(
    df: DataFrame,
    key: Sequence[str],
    scorer: Scorer,
    step: int = fixed.BUDGET_STEP,
    max_attempts: int | None = None,
    pause: float = 0.0,
) -> DataFrame:
    """Sends each prompt to the scorer: `[key, reply, attempts, gave_up, seconds]`.

    `df` has the columns of `build_prompts`. Rows go to the scorer in Arrow batches, in the
    tasks that hold them. A prompt without a reply is tried again with `step` more budget, and so
    is a batch whose scorer raised an error, until all have a reply. With `max_attempts` a row is
    given up after so many: its reply is null and `gave_up` is true, or, if the last attempt
    raised an error, that error ends the job. `seconds` is the time of the batches a row took
    part in, divided among their rows.

    After an error the next attempt waits `pause` seconds, and twice as long after each further
    one in a row, up to `LONGEST_PAUSE`; errors are written to the task's log. Mistakes in the
    scorer's code, and one error `SAME_ERRORS` times in a row, end the job.
    """
    fields = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    schema = ", ".join(
        [f"`{k}` {fields[k]}" for k in key] + ["reply string", "attempts int", "gave_up boolean", "seconds double"]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = len(batch)
            prompts, budgets = batch["prompt"].tolist(), batch["budget"].tolist()
            answers, attempts, seconds = [None] * n, [0] * n, [0.0] * n
            waiting = list(range(n))
            turn, said, times = 0, "", 0
            while waiting and (max_attempts is None or turn < max_attempts):
                turn += 1
                started = time.perf_counter()
                try:
                    got = scorer([prompts[i] for i in waiting], [budgets[i] for i in waiting])
                except MISTAKES:
                    raise
                except Exception as error:
                    now = f"{type(error).__name__}: {error}"
                    said, times = now, times + 1 if now == said else 1
                    print(f"attempt {turn} for {len(waiting)} prompts: {now}", file=sys.stderr)
                    if turn == max_attempts or times >= SAME_ERRORS:
                        raise
                    got = [None] * len(waiting)
                    time.sleep(min(LONGEST_PAUSE, pause * 2.0 ** min(times - 1, 30)))
                else:
                    said, times = "", 0
                if len(got) != len(waiting):
                    raise ValueError(f"{len(got)} replies to {len(waiting)} prompts")
                share = (time.perf_counter() - started) / len(waiting)
                for i, answer in zip(waiting, got):
                    answers[i] = answer
                    attempts[i] += 1
                    seconds[i] += share
                    budgets[i] += step
                waiting = [i for i in waiting if answers[i] is None]
            yield batch[list(key)].assign(
                reply=answers,
                attempts=attempts,
                gave_up=[answer is None for answer in answers],
                seconds=seconds,
            )

    asked = df.select(*dict.fromkeys([*key, "prompt", "budget"]))
    return asked.mapInPandas(run, schema)


def committed(df: DataFrame, key: Sequence[str], path: str) -> DataFrame | None:
    """The replies that earlier runs have left at `path`, one a key; None if there are none."""
    try:
        found = df.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    # A task that was run twice may have left its replies twice.
    return found.dropDuplicates(list(key))


def annotate_into(
    df: DataFrame,
    key: Sequence[str],
    scorer: Scorer,
    path: str,
    step: int = fixed.BUDGET_STEP,
    max_attempts: int | None = None,
    pause: float = 1.0,
    commit_rows: int = COMMIT_ROWS,
) -> DataFrame:
    """Labels into a table of replies that outlives the job, and returns it, one row a key.

    Prompts are dealt to tasks of about `commit_rows`, and the replies of a task are in the table
    as soon as it has ended. A job that is run again after a stop asks only prompts whose key has
    no reply there (an anti-join), so that at most the batches then in work are asked again. Rows
    that were given up count as answered; delete the table to ask them anew. Keys are compared as
    they are, null keys too, and must identify a prompt.
    """
    key = list(key)
    done = committed(df, key, path)
    left = df
    if done is not None:
        named = done.select(*[F.col(k).alias(f"_done_{k}") for k in key])
        same = F.lit(True)
        for k in key:
            same = same & df[k].eqNullSafe(named[f"_done_{k}"])
        left = df.join(named, same, "left_anti")
    n = left.count()
    if n:
        dealt = left.repartition(max(1, -(-n // commit_rows)), *key)
        found = annotate(dealt, key, scorer, step, max_attempts, pause)
        # Files of a task move to the table when it ends, not when the job does.
        writer = found.write.mode("append")
        writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)
    done = committed(df, key, path)
    return annotate(left.limit(0), key, scorer) if done is None else done


def parse_reply(
    df: DataFrame, reply: str, subjects: Sequence[str], echo: str | None = None
) -> DataFrame:
    """Adds the normalised `text`, its `rating` and its `sentiment`; null where absent.

    `echo` names a prompt column whose echo is taken out of the reply.
    """
    before, after = fixed.REPLY_FRAME
    echoed = (
        F.concat(F.lit(before), F.col(echo), F.lit(after)) if echo else F.lit("")
    )
    return (
        df.withColumn("text", replies.normalise_reply(F.col(reply), echoed))
        .withColumn("rating", replies.reply_rating(F.col("text")))
        .withColumn("sentiment", replies.reply_subject(F.col("text"), subjects))
    )
