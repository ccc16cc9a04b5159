"""``python -m gridwright ...`` runs one refresh (see gridwright.plans.refresh)."""

from gridwright.plans.refresh import main

main()
