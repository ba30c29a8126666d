"""``python -m claimlake <job> ...`` runs the command line (see ``claimlake.cli``)."""

from claimlake.cli import main

raise SystemExit(main())
