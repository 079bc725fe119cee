from __future__ import annotations

import pytest

from ledgerline import sources
from ledgerline.plans import people, products, revenue

TRANSACTIONS = """\
transaction_id,user_id,age,product_category,region,city,price,status,transaction_date,subscription
1,U1,25, Toys ,West,Oslo,100.5,done,2024-01-05,Free
1,U1,25, Toys ,West,Oslo,100.5,done,2024-01-05,Free
2,U2,17,Toys,West,Oslo,50,done,2024-01-06,Free
3,,30,Toys,East,Rome,70,done,2024-01-07,Free
4,U4,,Books,East,Rome,70,done,2024-01-07,Free
5,U5,100,Books, East ,Rome,,,2024-01-08, Premium
6,U6,40,Books,East,Bern,2500.129,done,08/01/2024,Premium
7,U7,41,Toys,West,Bern,200,done,2024-01-09,Free
7,U7,41,Toys,West , Bern,200,done,2024-01-09,Free
"""


@pytest.fixture
def transactions(spark, tmp_path):
    file = tmp_path / "transactions.csv"
    file.write_text(TRANSACTIONS)
    return str(file)


def test_revenue_reports(spark, transactions, tmp_path):
    target = str(tmp_path / "out")
    reports = revenue.run_revenue_job(spark, transactions, target)
    by_category = [tuple(r) for r in reports.by_category.collect()]
    # Copies that differ in padding only are not duplicates, and cities are not trimmed.
    assert by_category == [("Books", 2, 2500.13, 1250.07), ("Toys", 3, 500.5, 166.83)]
    assert [tuple(r) for r in reports.by_region.collect()] == [
        ("East", 2, 2500.13, 1250.07),
        ("West", 3, 500.5, 166.83),
    ]
    assert [r["city"] for r in reports.top_cities.collect()] == ["Bern", " Bern", "Oslo", "Rome"]
    back = sources.read_csv(spark, f"{target}/revenue_by_category", reports.by_category.schema)
    assert [tuple(r) for r in back.collect()] == by_category


def test_cleaned_transactions(spark, transactions):
    cleaned = revenue.clean_transactions(revenue.load_transactions(spark, transactions))
    found = {r["transaction_id"]: r for r in cleaned.collect()}
    assert set(found) == {1, 5, 6, 7}
    assert (found[5]["price"], found[5]["status"], found[5]["region"]) == (0.0, "Unknown", "East")
    assert found[6]["price"] == 2500.13 and found[6]["value_segment"] == "High Value"
    assert found[6]["transaction_date"] is None and found[1]["value_segment"] == "Standard"


def test_stepwise_cleaning_keeps_rows_without_user(spark, transactions):
    cleaned = revenue.clean_in_steps(revenue.load_transactions(spark, transactions))
    found = {r["transaction_id"]: r for r in cleaned.collect()}
    assert set(found) == {1, 3, 5, 6, 7}
    assert found[6]["price"] == 2500.129 and found[7]["city"] == "Bern"


def test_counts_come_from_one_pass_and_match_the_steps(spark, transactions, plan_of):
    raw = revenue.load_transactions(spark, transactions)
    counts = revenue.cleaning_counts(raw)
    assert tuple(counts.first()) == (9, 1, 6, 5)
    assert revenue.clean_transactions(raw).count() == 5
    assert plan_of(counts).count("FileScan") == 1


EMPLOYEES = [
    (40, "Ivo", "Harbour", 30250.25, "2011-02-30", "Riga", 14),  # no such day
    (41, "Uma", "Archive", None, "2015-11-30", "Cork", 6),
    (42, "Lin", "Harbour", 90000.0, None, "Riga", 9),
    (43, "Zoe", "Archive", 69999.5, "2019-04-01", "Lund", 4),
    (44, "Kai", "Archive", 80000.0, "2024-07-09", None, 0),
    (45, None, "Harbour", 45000.0, "2018-09-21", "Cork", 7),
]


@pytest.fixture
def staff(spark):
    raw = sources.inline_table(spark, EMPLOYEES, people.EMPLOYEES)
    return people.with_pay_columns(people.clean_employees(raw))


def test_pay_columns(staff):
    found = {r["emp_id"]: r for r in staff.collect()}
    assert set(found) == {40, 41, 42, 43, 44}
    assert [found[i]["salary_grade"] for i in (40, 41, 42, 43)] == ["C", "B", "A", "C"]
    assert (found[41]["salary"], found[41]["annual_bonus"], found[41]["total_comp"]) == (80000, 8000, 88000)
    assert (found[40]["annual_bonus"], found[40]["total_comp"]) == (3025.03, 33275.28)
    assert [found[i]["join_year"] for i in (40, 42, 43)] == [None, None, 2019]


def test_department_report(staff):
    assert [tuple(r) for r in people.department_report(staff).collect()] == [
        ("Archive", 3, 76666.5, 80000.0, 69999.5, 252999.45),
        ("Harbour", 2, 60125.13, 90000.0, 30250.25, 132275.28),
    ]


def test_pay_ranks_leave_gaps_after_ties(staff):
    ranks = {r["emp_id"]: r["dept_salary_rank"] for r in people.pay_ranks(staff).collect()}
    assert ranks == {41: 1, 44: 1, 43: 3, 42: 1, 40: 2}


def test_filter_and_rename(staff):
    assert [r["emp_id"] for r in people.well_paid(staff, "Archive", 75000.0).orderBy("emp_id").collect()] == [41, 44]
    assert "employee_name" in people.with_readable_names(staff).columns


def test_saved_staff_keeps_types(staff, tmp_path, rows):
    back = people.save_staff(staff, people.department_report(staff), str(tmp_path))
    assert back.dtypes == staff.dtypes
    assert rows(back.select("emp_id", "total_comp")) == rows(staff.select("emp_id", "total_comp"))
    assert len(list((tmp_path / "department_csv").glob("part-*.csv"))) == 1


def test_ratings(spark, rows):
    raw = spark.createDataFrame(
        [(1, 9.5, 4.0, 10, 1.0), (1, 9.5, 4.0, 10, 1.0), (2, None, None, 7, None)], products.RATINGS
    )
    assert rows(products.clean_ratings(raw)) == [(1, 9.5, 4.0, 10, 40.0), (2, 0.0, 0.0, 7, 0.0)]
    assert products.well_rated(raw).count() == 2
    assert products.prices(raw).columns == ["product_id", "final_price"]
