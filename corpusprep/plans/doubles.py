"""Stand-ins for the classifier and the chat model, for queries and tests.

No job uses one by default: a caller names the model and the completer.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusprep.fixed import AD, NON_AD


class RuleAdModel:
    """An ad when digits * 200 > length or length < 300 (code points)."""

    def predict(self, texts: list[str]) -> list[str]:
        s = pd.Series(texts, dtype="object")
        n = s.str.len()
        is_ad = (s.str.count(r"[0-9]") * 200 > n) | (n < 300)
        return [AD if x else NON_AD for x in is_ad]


def rule_model() -> RuleAdModel:
    return RuleAdModel()


def rule_label(text: Column) -> Column:
    """The same rule as a native expression."""
    n = F.char_length(F.coalesce(text, F.lit("")))
    digits = F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[0-9]"))
    return F.when((digits * 200 > n) | (n < 300), F.lit(AD)).otherwise(F.lit(NON_AD))


def recorded_completer():
    """A completer whose reply is a function of the request: keywords from the metadata, no JSON for
    every 10th article number, no usage for every 9th, and a usage total of 0 for every 4th."""

    def complete(request: dict) -> dict:
        m = re.search(r"(\d+)$", request["k_id"] or "")
        n = int(m.group(1)) if m else 0
        words = [request["k_newspaper"], " ", f"{request['k_language']} press", f"year {request['k_year']}"]
        listed = '{"english_keywords": [' + ", ".join(f'"{w}"' for w in words) + "]}"
        out = {"reply": "not json {" if n % 10 == 0 else listed}
        if n % 9:
            prompt = len(request["k_article"]) // 4 + 20
            out |= {"prompt_tokens": prompt, "completion_tokens": 12, "total_tokens": 0 if n % 4 == 0 else prompt + 12}
        return out

    return complete
