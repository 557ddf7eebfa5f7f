"""Whole loads: staging, vault loading and the jobs that chain them."""
