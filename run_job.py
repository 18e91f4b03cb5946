"""Launcher for ``spark-submit``."""

from shelfwise.__main__ import main

if __name__ == "__main__":
    main()
