"""spark-submit jobs/gold.py --base <folder>"""

from jobs import steps
from jobs.session import arguments, session

if __name__ == "__main__":
    args = arguments(__doc__)
    spark = session("gold")
    steps.gold(spark, args)
