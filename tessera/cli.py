"""Commands: run, merge-base, repair-base, dedupe-base, inspect, models; one settings file each.

    python -m tessera.cli run settings.toml [--date YYYY-MM-DD]
"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from tessera.operators import state
from tessera.plans import scenarios
from tessera.providers import Provider, Rules
from tessera.sources import sheet


def main(args: list[str] | None = None, provider: Provider | None = None, spark: SparkSession | None = None):
    p = argparse.ArgumentParser(prog="tessera")
    p.add_argument("command", choices=["run", "merge-base", "repair-base", "dedupe-base", "inspect", "models"])
    p.add_argument("settings")
    p.add_argument("--date", default=datetime.date.today().isoformat())
    a = p.parse_args(args)
    s = scenarios.load_settings(a.settings)
    provider = provider or Rules(list(s.categories))
    if a.command == "models":
        out = provider.health()
    else:
        spark = spark or SparkSession.builder.appName("tessera").getOrCreate()
        if a.command == "inspect":
            out = [{"sheet": name} | r.asDict() for name, df in sheet.read_sheets(spark, s.source).items() for r in state.profile(df).collect()]
        else:
            command = {"run": scenarios.tickets_to_base, "merge-base": scenarios.merge_base, "repair-base": scenarios.repair_base, "dedupe-base": scenarios.dedupe_base}[a.command]
            out = command(spark, s, provider, a.date)
            state.call_summary(scenarios.Base(spark, s).calls()).show(truncate=False)
    print(out)
    return out


if __name__ == "__main__":
    main()
