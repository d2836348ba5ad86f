"""The feeds, composed of operators, and the jobs that read and publish them."""
