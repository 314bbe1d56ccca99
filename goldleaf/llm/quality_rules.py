"""Line-first cleaning: judge each line, drop the failures, reject texts that lose too much.

Line rules, in this order (the first that fires names the line's fault):

* ``symbols``: a third or more of the line's words carry one of ``# * $ % & | < >``;
* ``shouting``: half or more of its words (three at least) end in two exclamation marks;
* ``navigation``: three or more stand-alone separators, or a list of links, or at most three words
  without an ending mark beside another such line;
* ``boilerplate``: a phrase of licences, cookie notices, placeholders and site footers;
* ``punctuation``: four words or more and no word with an ending mark.

A line without a word is kept, it loses nothing. A text is rejected when the removed lines hold
more than ``max_lost`` of its words, or when the base rules fail (fewer than 50 words, or more than
half of the words inside repeated three-word windows).

Null text counts as a text without words: all counts 0, ``base_failed`` true. Very long texts are
read whole. Repeated rows are judged each for itself; an empty table gives an empty result. The
verdict is a column, so columns of any name pass through untouched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import free_name
from goldleaf.llm.words import WORD

SYMBOL = re.compile(r"[#*$%&|<>]")
SEPARATORS = {"|", "»", "›", ">", "·", "•", "/", "::", "→"}
# Closing quotes and brackets may stand after the mark.
ENDING = re.compile(r"[.!?…:;。！？][\"'”’»)\]*]*(?=\s|$)")
LINK = re.compile(r"^(https?://|www\.)\S+$")
# Fixed phrases, lower case.
BOILERPLATE = (
    "all rights reserved",
    "licensed under the",
    "spdx-license-identifier",
    "this work is licensed",
    "permission is hereby granted",
    "cookie policy",
    "we use cookies",
    "accept cookies",
    "privacy policy",
    "terms of service",
    "terms of use",
    "terms and conditions",
    "lorem ipsum",
    "enable javascript",
    "javascript is disabled",
    "subscribe to our newsletter",
    "click here",
    "powered by",
    "back to top",
)
VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, lost_words long, failed_lines long, faults array<string>, clean_text string"
)


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    max_lost: float = 0.3
    symbol_share: float = 1 / 3


def line_fault(line: str, words: list[str], rules: Rules, beside_short: bool) -> str | None:
    """The first rule that the line breaks."""
    n = len(words)
    if n == 0:
        return None
    separators = sum(word in SEPARATORS for word in words)
    if separators >= 3 or sum(bool(LINK.match(word)) for word in words) * 2 > n:
        return "navigation"
    if SYMBOL.search(line) and sum(bool(SYMBOL.search(word)) for word in words) >= rules.symbol_share * n:
        return "symbols"
    if n >= 3 and "!!" in line and 2 * sum(word.endswith("!!") for word in words) >= n:
        return "shouting"
    lowered = line.lower()
    if any(phrase in lowered for phrase in BOILERPLATE):
        return "boilerplate"
    if not ENDING.search(line):
        if n > 3:
            return "punctuation"
        if beside_short:
            return "navigation"
    return None


def repeated_window_words(words: list[str], size: int = 3) -> int:
    """How many words stand in a window of ``size`` words that the text has twice or more."""
    n = len(words)
    if n <= size:
        return 0
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    window = ids[: n - size + 1]
    for place in range(1, size):
        _, window = np.unique(window, return_inverse=True)
        window = window * len(numbers) + ids[place : n - size + 1 + place]
    _, window, counts = np.unique(window, return_inverse=True, return_counts=True)
    again = counts[window] > 1
    covered = np.zeros(n, bool)
    for place in range(size):
        covered[place : n - size + 1 + place] |= again
    return int(covered.sum())


def judge(text: str | None, rules: Rules = Rules()) -> tuple:
    """The values of ``VERDICT`` for one text."""
    text = text or ""
    lines = text.split("\n")
    split = [WORD.findall(line) for line in lines]
    words = [word for row in split for word in row]
    seen: set[str] = set()
    again = 0
    for line, row in zip(lines, split):
        if row:
            again += line in seen
            seen.add(line)
    repeated = repeated_window_words(words)
    n = len(words)
    base_failed = n < rules.min_words or 100 * repeated > rules.max_repeat_percent * n

    short = [0 < len(row) <= 3 and not ENDING.search(line) for line, row in zip(lines, split)]
    faults, kept_lines, lost, failed = [], [], 0, 0
    for place, (line, row) in enumerate(zip(lines, split)):
        beside = short[place] and any(short[i] for i in (place - 1, place + 1) if 0 <= i < len(short))
        fault = line_fault(line, row, rules, beside)
        if fault is None:
            kept_lines.append(line)
        else:
            lost += len(row)
            failed += 1
            if fault not in faults:
                faults.append(fault)
    kept = not base_failed and lost <= rules.max_lost * n
    return (
        n, sum(map(len, words)), len(SYMBOL.findall(text)), again, repeated, base_failed,
        kept, lost, failed, sorted(faults), "\n".join(kept_lines) if failed else text,
    )


def verdict(text: Column, rules: Rules = Rules()) -> Column:
    """The verdict on a text column, as a struct with the fields of ``VERDICT``."""

    @F.pandas_udf(VERDICT)
    def judged(texts: pd.Series) -> pd.DataFrame:
        names = [field.split()[0] for field in VERDICT.split(", ")]
        return pd.DataFrame([judge(text, rules) for text in texts], columns=names)

    # the optimiser would put a copy of the call into a filter on its result, and judge every text twice
    return judged.asNondeterministic()(text)


def kept_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their failed lines removed, and all their columns.

    ``n_chars``, where the table has it, is the length of the cleaned text.
    """
    name = free_name(docs, "rules")
    judged = docs.withColumn(name, verdict(F.col("text"), rules)).where(F.col(name)["kept"])
    changes = {"text": F.col(name)["clean_text"]}
    if "n_chars" in docs.columns:
        changes["n_chars"] = F.length(F.col(name)["clean_text"]).cast(docs.schema["n_chars"].dataType)
    return judged.withColumns(changes).select(*docs.columns)
