"""spark-submit run.py JOB ...   (run.py --help lists the jobs)"""

from tillflow.jobs import main

if __name__ == "__main__":
    main()
