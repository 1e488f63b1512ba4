"""Entry point for spark-submit; ship the package with --py-files."""

from scoreflow.cli import main

if __name__ == "__main__":
    main()
