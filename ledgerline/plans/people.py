"""Employees: clean, derive pay columns, department statistics, ranks, files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, LongType, StringType, StructField, StructType

from ledgerline.operators import cleaning, filters, shaping, transforms
from ledgerline.operators.aggregates import statistics
from ledgerline.operators.ordering import descending, ordered
from ledgerline.operators.ranking import rank_rows
from ledgerline.sources import read_parquet, write_csv, write_parquet
from ledgerline.workspace import freeze

# Fixed layout of the input.
EMPLOYEES = StructType(
    [
        StructField("emp_id", LongType()),
        StructField("emp_name", StringType()),
        StructField("department", StringType()),
        StructField("salary", FloatType()),
        StructField("join_date", StringType()),
        StructField("city", StringType()),
        StructField("experience_yr", IntegerType()),
    ]
)

# Fixed values of the pay rules.
DEFAULT_SALARY = 80000.0
GRADES = [(90000.0, "A"), (70000.0, "B")]
LOWEST_GRADE = "C"
BONUS = "0.10"


def clean_employees(raw: DataFrame, default_salary: float = DEFAULT_SALARY) -> DataFrame:
    named = cleaning.drop_rows_missing(raw, "emp_name")
    return cleaning.fill_columns(named, {"salary": default_salary})


def well_paid(cleaned: DataFrame, department: str, above: float) -> DataFrame:
    """People of one department paid more than a limit."""
    kept = filters.where_all(
        cleaned, F.col("department") == department, F.col("salary") > F.lit(above)
    )
    return shaping.project(kept, "emp_id", "emp_name", "department", "salary", "city")


def with_readable_names(cleaned: DataFrame) -> DataFrame:
    return shaping.rename_columns(
        cleaned, {"emp_name": "employee_name", "experience_yr": "years_of_experience"}
    )


def with_pay_columns(cleaned: DataFrame) -> DataFrame:
    graded = transforms.add_band(cleaned, "salary_grade", "salary", GRADES, LOWEST_GRADE)
    bonus = transforms.add_share(graded, "annual_bonus", "salary", BONUS)
    total = transforms.add_raised(bonus, "total_comp", "salary", BONUS)
    return transforms.add_year(total, "join_year", "join_date")


def department_report(staff: DataFrame) -> DataFrame:
    # Salaries are single-precision, so they have no stated number of digits.
    measures = {
        "headcount": ("count", "emp_id"),
        "avg_salary": ("mean", "salary", 2),
        "max_salary": ("max", "salary"),
        "min_salary": ("min", "salary"),
        "total_compensation": ("total", "total_comp", 2),
    }
    stats = statistics(staff, measures, ["department"], scales={"total_comp": 2})
    return ordered(stats, [descending("avg_salary")])


def pay_ranks(staff: DataFrame) -> DataFrame:
    """Rank by salary within each department; ``staff`` is computed once."""
    staff = freeze(staff)
    ranked = rank_rows(staff, [descending("salary")], ["department"], name="dept_salary_rank")
    chosen = shaping.project(
        ranked, "emp_id", "emp_name", "department", "salary", "dept_salary_rank"
    )
    return ordered(chosen, ["department", "dept_salary_rank", "emp_id"])


def save_staff(staff: DataFrame, report: DataFrame, target: str) -> DataFrame:
    """Write staff as CSV and Parquet and the report as CSV; read the Parquet back."""
    write_csv(staff, f"{target}/employees_csv")
    write_parquet(staff, f"{target}/employees_parquet")
    write_csv(report, f"{target}/department_csv", files=1)
    back = read_parquet(staff.sparkSession, f"{target}/employees_parquet")
    if back.dtypes != staff.dtypes:
        raise ValueError(f"columns changed on the way: {staff.dtypes} to {back.dtypes}")
    return back
