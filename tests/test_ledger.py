"""Ledger rules on small tables."""

from datetime import datetime

import pytest

from quirebind import fixed
from quirebind.operators import intake, ledger

T0 = datetime(2024, 1, 1)
JOB = (
    "job_id string, user_id string, original_filename string, file_key string, "
    "bundle_key string, status string, error_message string, units_count int, "
    "created_at timestamp, updated_at timestamp"
)


def job(job_id, user, status="COMPLETED", key="k", day=1):
    at = datetime(2024, 1, day)
    return (job_id, user, "f.md", f"o/{job_id}", key, status, None, 1, at, at)


@pytest.fixture
def jobs(spark):
    return spark.createDataFrame(
        [job("j1", "ana"), job("j2", "ana", "PENDING", None, 2), job("j3", "ana", key="", day=3),
         job("j4", "bob", "INVALID", None), job("j5", "bob", day=5)], JOB,
    )


@pytest.fixture
def logs(spark):
    return spark.createDataFrame(
        [(f"l{i}", j, "S", "INFO", "m", T0) for i, j in enumerate(["j1", "j1", "j2", "j5", "jx"])],
        "log_id string, job_id string, step string, status string, message string, "
        "created_at timestamp",
    )


def ids(df, c="job_id"):
    return sorted(r[c] for r in df.collect())


def test_download_gate_takes_the_first_rule(spark, jobs):
    asked = [("r1", "j1", "ana"), ("r2", "j1", "bob"), ("r3", "nope", "ana"), ("r4", "j2", "ana"),
             ("r5", "j3", "ana"), ("r6", "j4", "ana")]
    requests = spark.createDataFrame(asked, "request_id string, job_id string, user_id string")
    got = {r.request_id: r for r in ledger.download_gate(requests, jobs).collect()}
    assert {k: r.reason for k, r in got.items()} == {
        "r1": "", "r2": fixed.NOT_OWNER, "r3": fixed.NOT_FOUND, "r4": fixed.NOT_READY % "PENDING",
        "r5": fixed.NO_BUNDLE, "r6": fixed.NOT_OWNER,
    }
    assert got["r1"].allowed and got["r1"].download_name == "bundle_j1.zip"


def test_isolation(spark, jobs):
    requests = spark.createDataFrame(
        [("a", "j1", "ana"), ("b", "j1", "bob")], "request_id string, job_id string, user_id string"
    )
    assert ids(ledger.row_isolation(jobs, requests), "request_id") == ["a"]


def test_cascade_delete_needs_the_owner(spark, jobs, logs):
    requests = spark.createDataFrame(
        [("j1", "ana"), ("j3", "ana"), ("j5", "ana"), ("nope", "ana")], "job_id string, user_id string"
    )
    left_jobs, left_logs, keys = ledger.cascade_delete(jobs, logs, requests)
    assert ids(left_jobs) == ["j2", "j4", "j5"]
    assert ids(left_logs, "log_id") == ["l2", "l3", "l4"]
    assert ids(keys, "object_key") == ["k", "o/j1", "o/j3"]


def test_orphans(jobs, logs):
    assert ids(ledger.orphans(logs, jobs, "job_id"), "log_id") == ["l4"]


def test_lists_are_newest_first_and_blank_nulls(spark, jobs):
    users = spark.createDataFrame([("ana",)], "user_id string")
    rows = ledger.user_jobs(jobs, users).collect()
    assert [r.job_id for r in rows] == ["j3", "j2", "j1"]
    assert [r.bundle_key for r in rows] == ["", "", "k"]


@pytest.mark.parametrize(
    "page, size, expected",
    [(1, 2, ["j2", "j3"]), (2, 2, ["j1"]), (9, 2, ["j1"]), (0, 2, ["j2", "j3"]), (1, 5, ["j1", "j2", "j3"])],
)
def test_pages_are_clamped(spark, jobs, page, size, expected):
    users = spark.createDataFrame([("ana",)], "user_id string")
    assert ids(ledger.jobs_page(jobs, users, page, size)) == expected


def test_lookup_tells_missing_from_found(spark, jobs):
    keys = spark.createDataFrame([("j1",), ("nope",)], "job_id string")
    got = {r.job_id: r.found for r in ledger.job_lookup(jobs, keys).collect()}
    assert got == {"j1": True, "nope": False}


def test_first_registration_wins(spark):
    users = spark.createDataFrame([("u0", "Taken@x.com")], "user_id string, email string")
    asked = [("a@x.com", "u1", 5), ("a@x.com", "u2", 3), ("Taken@x.com", "u3", 1),
             ("taken@x.com", "u4", 1)]
    requests = spark.createDataFrame(asked, "email string, user_id string, arrival long")
    got = {r.email: r.user_id for r in ledger.register_unique(requests, users).collect()}
    assert got == {"a@x.com": "u2", "taken@x.com": "u4"}


def test_transitions(spark):
    states = ["PENDING", "PROCESSING", "FAILED", "PROCESSING", "COMPLETED", "PROCESSING", "PENDING"]
    events = spark.createDataFrame(
        [("j", i, s) for i, s in enumerate(states)] + [("k", 0, "PROCESSING"), ("m", 0, "PENDING"),
                                                      ("m", 1, "FAILED")],
        "job_id string, seq int, status string",
    )
    rows = ledger.status_transitions(events).orderBy("job_id", "seq").collect()
    assert [r.legal for r in rows] == [True] * 5 + [False, False] + [False] + [True, True]


def test_accept_is_repeatable_and_gated(spark):
    uploads = spark.createDataFrame(
        [("u1", "ana", "a.MD", T0), ("u2", "ana", "b.exe", T0), ("u3", "ana", "c", T0)],
        "upload_id string, user_id string, filename string, created_at timestamp",
    )
    made, again = intake.accept_jobs(uploads), intake.accept_jobs(uploads)
    (row,) = made["jobs"].collect()
    assert row == again["jobs"].collect()[0]
    assert row.file_key == f"originals/ana/{row.job_id}.MD" and row.status == "PENDING"
    assert made["logs"].count() == made["messages"].count() == 1
    reasons = {r.upload_id: r.reason for r in made["rejected"].collect()}
    assert reasons == {"u2": fixed.REJECTED_FORMAT % ".exe", "u3": fixed.REJECTED_FORMAT % ""}


ID = "0a1b2c3d-0000-4000-8000-00000000000f"


@pytest.mark.parametrize(
    "value, problem",
    [
        (f'{{"job_id":"{ID}","user_id":"{ID}","extra":1}}', None),
        (f'{{"job_id":"{ID}"', "json"),
        ("nonsense", "json"),
        (f'{{"job_id":"x","user_id":"{ID}"}}', "id"),
        (f'{{"job_id":"","user_id":"{ID}"}}', "id"),
        (f'{{"user_id":"{ID}"}}', None),
        (f'{{"job_id":"{ID}","user_id":"{ID}","timestamp":"yesterday"}}', "timestamp"),
        (f'{{"job_id":"{ID}","user_id":"{ID}","timestamp":"2024-01-02T03:04:05Z"}}', None),
    ],
)
def test_message_problems(spark, value, problem):
    df = spark.createDataFrame([(value,)], "value string")
    (row,) = intake.parse_messages(df).collect()
    assert row.problem == problem
    if '"job_id"' not in value and problem is None:
        assert row.job_id == fixed.NIL_ID


def test_first_delivery_of_jobs_not_completed(spark):
    parsed = spark.createDataFrame(
        [("a", 2, "late", None), ("a", 1, "early", None), ("b", 1, "done", None), ("c", 1, "bad", "id")],
        "job_id string, arrival int, file_key string, problem string",
    ).selectExpr("*", "'u' user_id", "'f' original_filename", "'t' timestamp")
    completed = spark.createDataFrame([("b",)], "job_id string")
    rows = intake.idempotent_intake(parsed, completed).collect()
    assert [(r.job_id, r.file_key) for r in rows] == [("a", "early")]


def test_pages_of_a_long_list(spark):
    """One user with most jobs, in many parts: first, middle, last and beyond."""
    at = lambda n: datetime.fromordinal(730000 + n % 50)
    rows = [(f"j{n:04}", "ana" if n % 10 else "bob", "f.md", "o", "k", "COMPLETED", None, 1, at(n), at(n)) for n in range(700)]
    jobs = spark.createDataFrame(rows, JOB).repartition(6)
    users = spark.createDataFrame([("ana",), ("bob",)], "user_id string")
    for page in (1, 40, 90, 500):
        got = {(r.user_id, r.position): (r.job_id, r.page) for r in ledger.jobs_page(jobs, users, page, 7).collect()}
        want = {}
        for user in ("ana", "bob"):
            own = sorted((r for r in rows if r[1] == user), key=lambda r: (-r[8].toordinal(), r[0]))
            shown = min(page, -(-len(own) // 7))
            want |= {(user, i + 1): (own[i][0], shown) for i in range(len(own)) if (shown - 1) * 7 <= i < shown * 7}
        assert got == want
