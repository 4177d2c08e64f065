"""Start a batch job: spark-submit run.py <job> ... (see panelwright/jobs.py)."""

from panelwright.jobs import main

if __name__ == "__main__":
    main()
