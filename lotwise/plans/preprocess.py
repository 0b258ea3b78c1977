"""Raw listings to a clean feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.functions.numeric import nan_as_null
from lotwise.operators import cleaning as C
from lotwise.operators.encoding import column_names_of, multi_hot
from lotwise.operators.quantiles import quantile_values
from lotwise.sources.staging import stage


def clean_rows(df: DataFrame) -> DataFrame:
    """The part that looks at one row at a time: target, text, tenure, size."""
    df = C.drop_null_target(df)
    df = C.drop_identifier(df)
    df = C.standardize_text(df)
    df = C.canonicalize_tenure(df)
    return C.size_feature(df)


def preprocess(df: DataFrame, approx: bool = False) -> DataFrame:
    """Raw listings to model columns.

    The same as the operators one after the other: median imputation, density of
    all rows, price fences, transaction fences of what is left, rare States and
    Areas counted on what is left after that, type flags. Fits that do not
    depend on each other share a pass:

    1. write the cleaned rows, with the types as items (text cleaning is the costly part);
    2. median of the transactions and quartiles of the price;
    3. transactions per Area;
    4. quartiles of the transactions inside the price fences;
    5. frequencies of States, Areas and type items inside both fences.
    """
    rows = stage(C.cut_set(clean_rows(df)))
    quartiles = quantile_values(rows, [S.TARGET, S.TX], [0.25, 0.5, 0.75], approx)
    if S.TX in quartiles:
        rows = rows.withColumn(S.TX, F.coalesce(nan_as_null(F.col(S.TX)), F.lit(quartiles[S.TX][1])))
    shares = C.area_shares(rows)
    if S.TARGET in quartiles:
        q1, _, q3 = quartiles[S.TARGET]
        rows = rows.where(F.col(S.TARGET).between(*C.fences(q1, q3)))
    rows = C.iqr_filter(rows, S.TX, approx)
    frequencies = C.category_frequencies(rows)
    # The joins come after the filters, which then stay next to the scan.
    rows = C.add_density(rows, shares)
    # Staged apart, so that the few States are planned by their own size and not by that of the Areas.
    rare_states = stage(C.rare_among(frequencies, "State", C.MIN_STATE_ROWS))
    rare_areas = stage(C.rare_among(frequencies, "Area", C.MIN_AREA_ROWS))
    rows = C.bucket_rare_state(rows, rare=rare_states)
    rows = C.bucket_rare_area(rows, rare=rare_areas)
    items = frequencies.where("column = 'Type'").select("value")
    return multi_hot(rows, vocabulary=column_names_of(items))
