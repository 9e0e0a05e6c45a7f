"""E3 option logic, checked against a recording fake reader.

No database may be started in this environment (not even an in-process
one), so the JDBC reader is not run against a real connection here; this
test pins down which options it passes to Spark.
"""

from __future__ import annotations

from ledgerline.sinks.results import append_jdbc
from ledgerline.sources.jdbc import MAX_RANGES, read_jdbc_table, read_jdbc_tables


class _Row(dict):
    pass


class _Reader:
    def __init__(self, log, bounds):
        self.opts, self.log, self.bounds = {}, log, bounds

    def format(self, name):
        self.opts["format"] = name
        return self

    def option(self, key, value):
        self.opts[key] = value
        return self

    def options(self, **kw):
        self.opts.update(kw)
        return self

    def load(self):
        self.log.append(dict(self.opts))
        return self

    def first(self):
        return _Row(lo=self.bounds[0], hi=self.bounds[1])


class _Session:
    def __init__(self, bounds=(1, 1000)):
        self.log, self.bounds = [], bounds

    @property
    def read(self):
        return _Reader(self.log, self.bounds)

    class sparkContext:  # noqa: N801 -- mimics the attribute name
        defaultParallelism = 8


def test_plain_read_is_one_table_scan():
    s = _Session()
    read_jdbc_table(s, "jdbc:x://h/db", "accounts", {"user": "u"})
    (opts,) = s.log
    assert opts["dbtable"] == "accounts" and "partitionColumn" not in opts and opts["user"] == "u"


def test_partitioned_read_queries_bounds_then_splits():
    s = _Session(bounds=(10, 5000))
    read_jdbc_table(s, "jdbc:x://h/db", "transactions", partition_column="transaction_id", num_partitions=16)
    bounds_query, scan = s.log
    assert "MIN(transaction_id)" in bounds_query["query"]
    assert scan["partitionColumn"] == "transaction_id"
    assert (scan["lowerBound"], scan["upperBound"], scan["numPartitions"]) == (10, 5001, 16)


def test_given_bounds_skip_the_bounds_query_and_ranges_follow_the_width():
    s = _Session()
    read_jdbc_table(s, "jdbc:x://h/db", "customers", partition_column="customer_id", lower_bound=1, upper_bound=99, rows_per_task=10)
    (scan,) = s.log
    assert (scan["lowerBound"], scan["upperBound"], scan["numPartitions"]) == (1, 100, 10)


def test_empty_table_falls_back_to_plain_read():
    s = _Session(bounds=(None, None))
    read_jdbc_table(s, "jdbc:x://h/db", "customers", partition_column="customer_id")
    assert "partitionColumn" not in s.log[-1]


def test_empty_table_with_a_given_lower_bound():
    s = _Session(bounds=(None, None))
    read_jdbc_table(s, "jdbc:x://h/db", "customers", partition_column="customer_id", lower_bound=1)
    assert "partitionColumn" not in s.log[-1]


def test_sparse_ids_widen_the_ranges():
    s = _Session(bounds=(0, 2**62))
    read_jdbc_table(s, "jdbc:x://h/db", "customers", partition_column="customer_id")
    assert s.log[-1]["numPartitions"] == MAX_RANGES


def test_three_tables_split_on_their_keys():
    s = _Session(bounds=(1, 100))
    read_jdbc_tables(s, "jdbc:x://h/db", {"user": "u"}, rows_per_task=50)
    scans = {o["dbtable"]: (o["partitionColumn"], o["numPartitions"]) for o in s.log if "partitionColumn" in o}
    assert scans == {
        "customers": ("customer_id", 2), "accounts": ("account_id", 2), "transactions": ("transaction_id", 2),
    }


class _Writer(_Reader):
    def mode(self, name):
        return self.option("mode", name)

    def save(self):
        self.load()


def test_append_passes_its_options():
    s = _Session()

    class Frame:
        write = _Writer(s.log, None)

    assert append_jdbc(Frame(), "jdbc:x://h/db", "case_results", {"user": "u"}, batch_size=5) == "case_results"
    assert s.log == [{"format": "jdbc", "url": "jdbc:x://h/db", "user": "u", "dbtable": "case_results",
                      "batchsize": 5, "mode": "append"}]
