"""Entry point for ``spark-submit``."""

from topup_analytics.__main__ import main

main()
