"""All steps in turn; ends with an error before gold if the quality gate is not passed."""

from jobs import steps
from jobs.session import arguments, session

if __name__ == "__main__":
    args = arguments(__doc__)
    spark = session("run_all")
    rest = (steps.gold, steps.modeltests) if args.build_anyway else (steps.gate, steps.gold, steps.modeltests)
    for step in (steps.ingest, steps.transform, steps.validate, *rest):
        step(spark, args)
