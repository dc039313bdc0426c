"""Print the final (AQE) physical plan of chosen queries after running them.

Usage: python scripts/plans.py <sf_dir> name [name ...]  > docs/PLANS.md
"""

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetlens.catalog import open_fleet  # noqa: E402
from fleetlens.context import DEFAULT_CONTEXT as ctx  # noqa: E402
from fleetlens.plans.exports import EXPORTS  # noqa: E402
from fleetlens.plans.views import VIEWS  # noqa: E402
from fleetlens.session import build_session  # noqa: E402


def final_plan(df) -> tuple[str, list[str]]:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0]
    if "+- == Initial Plan ==" in tree:
        tree = tree.split("+- == Initial Plan ==")[0].rstrip()
    extra = [ln for ln in text.splitlines()
             if (ln.startswith("PushedFilters") and ln.strip() != "PushedFilters: []") or ln.startswith("ReadSchema")]
    return tree, extra


def main():
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(shuffle_partitions=16)
    t = open_fleet(spark, sf_dir)
    for n in names:
        df = EXPORTS[n].build(t, ctx) if n in EXPORTS else VIEWS[n](t, ctx)
        tree, extra = final_plan(df)
        print(f"### {n}\n\n```\n{tree}\n```\n")
        for ln in sorted(set(extra)):
            print(f"    {ln}")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
