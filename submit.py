"""Script for ``spark-submit``; see ``incident_mart.__main__`` for the jobs."""

from incident_mart.__main__ import main

if __name__ == "__main__":
    main()
