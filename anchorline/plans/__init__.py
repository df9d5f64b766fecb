"""End-to-end runs: each door's part, the merged publication, the claim refresh."""
