"""DataFrame operators: row-quality checks and the claim-check offload / resolve."""
