"""Sentences, prompts and number formats built from columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording of a store profile.
PROFILE_HEAD = "Store {0}: This is a type '{1}' store with assortment level '{2}'. "
PROFILE_COMPETITOR = "The nearest competitor is located {0} meters away. "
PROFILE_COMPETITOR_SINCE = "This competition has been active since month {0}, year {1}. "
PROFILE_NO_COMPETITOR = "There is no recorded nearby competition for this store. "
PROFILE_PROMO = "The store participates in continuous promotion (Promo2) since year {0}, week {1}. "
PROFILE_INTERVAL = "Promotion intervals are: {0}. "
PROFILE_NO_PROMO = "The store does not participate in the continuous Promo2 program. "

# Question asked per store and prompt.
STORE_QUESTION = "Store {0} sales profile assortment competition promo"
NO_CONTEXT = "No store context available."
ANALYSIS_PROMPT = """
You are an Elite Retail Business Consultant. 
Analyze the forecast and provide sharp, data-driven insights.

---
PREDICTED SALES: ${prediction}
STORE CONTEXT: {context}
CURRENT FEATURES: {input_data}
---

### BUSINESS INSIGHTS:
- **Driver Analysis**: Provide 1-2 bullet points on WHY this prediction was made (e.g., impact of Promo, Lags, or Store Type).
- **Actionable Strategy**: Provide 1-2 bullet points on WHAT the manager should do (e.g., inventory prep, staffing, or marketing).

*Guidelines: Keep it under 100 words. No fluff. Use professional consultant tone.*
"""


def fill(template: str, *values: Column, **named: Column) -> Column:
    """Template with ``{0}``, ``{1}`` or ``{name}`` slots as one concat of literals and columns."""
    slots = {str(position): value for position, value in enumerate(values)} | named
    parts: list[Column] = []
    rest = template
    while rest:
        places = {name: rest.find("{" + name + "}") for name in slots}
        places = {name: at for name, at in places.items() if at >= 0}
        if not places:
            parts.append(F.lit(rest))
            break
        name = min(places, key=places.get)
        if places[name]:
            parts.append(F.lit(rest[: places[name]]))
        parts.append(slots[name].cast("string"))
        rest = rest[places[name] + len(name) + 2:]
    return F.concat(*parts)


def quoted(value: object) -> str:
    """A value as a SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def plain_number(number: Column) -> Column:
    """A double as text without an exponent where it is whole: 1270.0, 12000000.0."""
    whole = (number == F.floor(number)) & (F.abs(number) < 1e16)
    return F.when(whole, number.cast("decimal(20,1)").cast("string")).otherwise(number.cast("string"))


def dollars(amount: Column) -> Column:
    """``$1,234.50``; the sign follows the dollar."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def signed_percent(value: Column) -> Column:
    return F.format_string("%+.1f%%", value)


def store_profile() -> Column:
    """One descriptive paragraph from the columns of a store row."""
    def whole(name: str) -> Column:
        return F.col(name).cast("bigint")

    distance = F.col("CompetitionDistance")
    since = F.when(
        F.col("CompetitionOpenSinceYear").isNotNull(),
        fill(PROFILE_COMPETITOR_SINCE, whole("CompetitionOpenSinceMonth"), whole("CompetitionOpenSinceYear")),
    ).otherwise("")
    competitor = F.when(
        distance.isNotNull(), F.concat(fill(PROFILE_COMPETITOR, plain_number(distance)), since)
    ).otherwise(PROFILE_NO_COMPETITOR)
    promotion = F.when(
        F.col("Promo2") == 1,
        F.concat(
            fill(PROFILE_PROMO, whole("Promo2SinceYear"), whole("Promo2SinceWeek")),
            fill(PROFILE_INTERVAL, F.coalesce(F.col("PromoInterval"), F.lit("nan"))),
        ),
    ).otherwise(PROFILE_NO_PROMO)
    return F.concat(fill(PROFILE_HEAD, whole("Store"), F.col("StoreType"), F.col("Assortment")), competitor, promotion)


def word_set(text: Column | str) -> Column:
    """Distinct lower-case runs of ASCII letters and digits in the whole text."""
    words = F.split(F.lower(text), "[^a-z0-9]+")
    return F.array_distinct(F.filter(words, lambda word: word != ""))


def analysis_prompt(prediction: Column, input_data: Column, context: Column) -> Column:
    return fill(ANALYSIS_PROMPT, prediction=prediction, input_data=input_data, context=context)
