"""Writing: bronze appends, layer refreshes, snapshots, manifests, rejects, ledgers."""
