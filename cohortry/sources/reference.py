"""Reference tables: code labels and value bands.

The texts below are fixed values: labels, codes and limits are those of the survey's
code book and of the published BMI standards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LABEL_SCHEMA = "variable string, code int, label string, ordinal_rank int"
BAND_SCHEMA = (
    "standard string, band_code int, band_label string, "
    "bmi_lower_inclusive double, bmi_upper_exclusive double"
)

# Variable, code, label, rank.
CODE_LABELS = """
GenHlth,1,Excellent,1
GenHlth,2,Very good,2
GenHlth,3,Good,3
GenHlth,4,Fair,4
GenHlth,5,Poor,5
Age,1,18-24 years,1
Age,2,25-29 years,2
Age,3,30-34 years,3
Age,4,35-39 years,4
Age,5,40-44 years,5
Age,6,45-49 years,6
Age,7,50-54 years,7
Age,8,55-59 years,8
Age,9,60-64 years,9
Age,10,65-69 years,10
Age,11,70-74 years,11
Age,12,75-79 years,12
Age,13,80 years or older,13
Education,1,Never attended school or only kindergarten,1
Education,2,Elementary (grades 1-8),2
Education,3,Some high school (grades 9-11),3
Education,4,High school graduate (grade 12 or GED),4
Education,5,Some college or technical school (1-3 years),5
Education,6,College graduate (4 years or more),6
Income,1,Less than USD 10000,1
Income,2,USD 10000 to less than 15000,2
Income,3,USD 15000 to less than 20000,3
Income,4,USD 20000 to less than 25000,4
Income,5,USD 25000 to less than 35000,5
Income,6,USD 35000 to less than 50000,6
Income,7,USD 50000 to less than 75000,7
Income,8,USD 75000 to less than 100000,8
Income,9,USD 100000 to less than 150000,9
Income,10,USD 150000 to less than 200000,10
Income,11,USD 200000 or more,11
Sex,0,Female,1
Sex,1,Male,2
Diabetes_binary,0,No diabetes,1
Diabetes_binary,1,Prediabetes or diabetes,2
"""

# Standard, band code, label, lower limit (inclusive), upper limit (exclusive).
BMI_BANDS = """
WHO_International,1,Underweight,0.0,18.5
WHO_International,2,Normal weight,18.5,25.0
WHO_International,3,Overweight,25.0,30.0
WHO_International,4,Obese,30.0,999.0
WHO_AsiaPacific,1,Underweight,0.0,18.5
WHO_AsiaPacific,2,Normal weight,18.5,23.0
WHO_AsiaPacific,3,Overweight,23.0,25.0
WHO_AsiaPacific,4,Obese,25.0,999.0
"""


def _values_table(spark: SparkSession, text: str, schema: str) -> DataFrame:
    """An inline relation: Spark knows its size, so it broadcasts it without a hint."""
    fields = [field.split() for field in schema.split(", ")]
    rows = []
    for line in text.strip().splitlines():
        cells = [
            f"CAST('{value}' AS {kind})" for value, (_, kind) in zip(line.split(","), fields)
        ]
        rows.append(f"({', '.join(cells)})")
    names = ", ".join(name for name, _ in fields)
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({names})")


def code_labels(spark: SparkSession) -> DataFrame:
    return _values_table(spark, CODE_LABELS, LABEL_SCHEMA)


def bmi_bands(spark: SparkSession, standard: str = "WHO_International") -> DataFrame:
    """``band_code, lower, upper, band_label`` of one standard, ready for ``operators.bands``."""
    return bands_of(_values_table(spark, BMI_BANDS, BAND_SCHEMA), standard)


def bands_of(table: DataFrame, standard: str = "WHO_International") -> DataFrame:
    return table.where(table.standard == standard).selectExpr(
        "CAST(band_code AS int) AS band_code",
        "CAST(bmi_lower_inclusive AS double) AS lower",
        "CAST(bmi_upper_exclusive AS double) AS upper",
        "band_label",
    )
