"""Wall seconds per registered key (cold, then warm) through the noop sink; prints a Markdown table.

Usage: python scripts/measure_keys.py SF_DIR CPUS [--oracle-only] [key ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lathe.plans import load_all  # noqa: E402
from lathe.session import local_session  # noqa: E402


def main():
    sf, cpus = sys.argv[1], sys.argv[2]
    args = sys.argv[3:]
    only = {a for a in args if not a.startswith("--")}
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus), app="lathe-measure")
    q, o = load_all()
    print(f"| key | oracle | cold s | warm s |\n| --- | --- | --- | --- |", flush=True)
    for k in q:
        if only and k not in only:
            continue
        if "--oracle-only" in args and k not in o:
            continue
        t = []
        for _ in range(2):
            t0 = time.perf_counter()
            q[k](spark, sf).write.format("noop").mode("overwrite").save()
            t.append(time.perf_counter() - t0)
        print(f"| `{k}` | {'S' if k in o else 'R'} | {t[0]:.2f} | {t[1]:.2f} |", flush=True)


if __name__ == "__main__":
    main()
