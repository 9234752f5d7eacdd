"""The model layer: staging, marts, their build, and the status report."""
