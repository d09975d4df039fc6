"""Physical-plan summary of every registered query (from explain("formatted")).

    python tools/plan_report.py [sf_dir] > docs/PLANS.md

Counts shuffles (hash exchanges), broadcasts and join strategies, and lists
the filters pushed to Parquet scans.  Nothing is executed except the size
checks and snapshot writes the builds themselves make.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dimforge.config import local_session  # noqa: E402
from dimforge.queries import QUERIES  # noqa: E402


def top_level_split(text: str) -> list[str]:
    parts, depth, cur = [], 0, ""
    for ch in text:
        depth += ch in "([" 
        depth -= ch in ")]"
        if ch == "," and depth == 0:
            parts.append(cur.strip())
            cur = ""
        else:
            cur += ch
    return parts + ([cur.strip()] if cur.strip() else [])


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


READING = """
## Reading the table

- **JVM-side only.** Every query runs in whole-stage code generation blocks
  (codegen spans), and no Python evaluation node appears: all expressions
  are built-in Spark functions.
- **No sort-merge join of a fact, no nested-loop join.** Every lookup's size is
  known first (recorded when it was written, or counted by `bounded_fits`, one
  job per join chain) and it is broadcast under the bound. If a lookup outgrows the bound, the same code plans a sort-merge
  join, and AQE splits a hot key (`tests/test_plan_shape.py`,
  `tests/test_skew.py`).
- **`conformed_plan`:**
  - the two sides of the merge of the site and farm lookups;
  - the grain sum of the current system (partial aggregation before it);
  - three DISTINCTs of small lookups (scenario, period, simulation), kept so
    that exact copies in a lookup cannot multiply fact rows;
  - one DISTINCT for each origin.

  The written dimensions lie in a folder for each origin, so `ID_ORIGEM_DB = 2000`
  and `= 1000` choose folders (`partition` filters). Published inputs carry
  their sizes; then the site and farm lookups are two broadcasts and nothing
  is merged.
- **`conformed_site`, 8 shuffles:** one DISTINCT per staged lookup (five
  snowflake levels and the region list) and one for each origin, which
  aggregate partially before their exchanges. Each lookup is a tiny table.
- **`load_all_published`, `reload_one_origin`:** the plans are those of the table
  read back; the second reads one version for each origin.
- **Pushdown:**
  - prefix tests (`StringStartsWith`), substring tests (`StringContains`),
    equality and IN filters all reach the scans;
  - the contains filter of `sql_over_view` goes through the union, the
    DISTINCT and the joins down to the legacy scan;
  - filters on computed values (`year(o_orderdate) <= 1999`) stay above the
    scan, as in the original loads.
"""


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, app="dimforge-plans")
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` (initial adaptive plans, local session settings).")
    print("Shuffles = exchanges other than broadcasts; BHJ/SMJ/BNLJ = broadcast-hash / sort-merge / "
          "nested-loop joins; codegen spans = whole-stage code generation blocks; Python eval = "
          "Python UDF nodes (none: every expression is a built-in Spark function).\n")
    print("| query | shuffles | broadcasts | BHJ | SMJ | BNLJ | aggregates | codegen spans | Python eval | "
          "filters pushed to Parquet |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        text = formatted(df)
        # codegen blocks are visible in the static plan (AQE inserts them per stage at run time)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        static = formatted(df.select("*"))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        codegen = len(set(re.findall(r"codegen id : (\d+)", static)))
        python_eval = len(re.findall(r"(?:Arrow|Batch)EvalPython", static))
        tree = text.split("\n\n")[0]
        pushed = sorted({p for m in re.findall(r"PushedFilters: \[(.*)\]\s*$", text, re.M)
                         for p in top_level_split(m) if p and not p.startswith("IsNotNull")})
        pushed += sorted({f"partition {p}" for m in re.findall(r"PartitionFilters: \[(.*?)\]\s*$", text, re.M)
                          for p in top_level_split(m) if p and not p.startswith("isnotnull")})
        pushed = list(dict.fromkeys(re.sub(r"#\d+", "", p) for p in pushed))
        print(f"| {name} | {len(re.findall(r'Exchange \(', tree)) - tree.count('BroadcastExchange')} "
              f"| {tree.count('BroadcastExchange')} | {tree.count('BroadcastHashJoin')} | {tree.count('SortMergeJoin')} "
              f"| {tree.count('BroadcastNestedLoopJoin')} | {tree.count('HashAggregate')} "
              f"| {codegen} | {python_eval} "
              f"| {'; '.join(pushed) or '-'} |")
    print(READING)
    spark.stop()


if __name__ == "__main__":
    main()
