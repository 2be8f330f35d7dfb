"""Customer dimension: age, tenure, activity and verification."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import first_match, flag, ladder, steps
from tillroll.functions.dates import boundary_diff
from tillroll.rules import (
    ACTIVITY,
    AGE_GROUP,
    NEVER_LOGGED_IN,
    TENURE_BY_DAYS,
    TENURE_BY_YEARS,
    VERIFIED_BOTH,
    VERIFIED_NONE,
    VERIFIED_ONE,
)


def customers(staged: DataFrame, as_of: date) -> DataFrame:
    today = F.lit(as_of)
    registered, login = F.col("registration_date"), F.col("last_login")
    email, phone = F.col("email_verified"), F.col("phone_verified")
    measured = staged.withColumns(
        {
            "age": boundary_diff("year", F.col("date_of_birth"), today),
            "days_since_registration": boundary_diff("day", registered, today),
            "months_since_registration": boundary_diff("month", registered, today),
            "years_since_registration": boundary_diff("year", registered, today),
            "days_since_last_login": boundary_diff("day", login, today),
            "is_fully_verified": flag(email & phone),
        }
    )
    by_days = steps(F.col("days_since_registration"), TENURE_BY_DAYS)
    by_years = steps(F.col("years_since_registration"), TENURE_BY_YEARS.steps)
    return measured.withColumns(
        {
            "age_group": ladder(F.col("age"), AGE_GROUP),
            "customer_tenure": first_match(by_days + by_years, TENURE_BY_YEARS.otherwise),
            "activity_status": F.when(login.isNull(), NEVER_LOGGED_IN).otherwise(
                ladder(F.col("days_since_last_login"), ACTIVITY)
            ),
            "verification_status": first_match(
                [(email & phone, VERIFIED_BOTH), (email | phone, VERIFIED_ONE)], VERIFIED_NONE
            ),
        }
    )
