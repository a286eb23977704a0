"""spark-submit jobs/transform.py --base <folder>"""

from jobs import steps
from jobs.session import arguments, session

if __name__ == "__main__":
    args = arguments(__doc__)
    spark = session("transform")
    steps.transform(spark, args)
