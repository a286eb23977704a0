"""spark-submit jobs/ingest.py --base <folder>"""

from jobs import steps
from jobs.session import arguments, session

if __name__ == "__main__":
    args = arguments(__doc__)
    spark = session("ingest")
    steps.ingest(spark, args)
