"""Launcher of the play-count job for ``spark-submit`` (see playtally/streaming/cli.py)."""

from playtally.streaming.cli import main

if __name__ == "__main__":
    main()
