"""``python -m caselake <job> ...`` runs the command-line jobs (see ``caselake.jobs``)."""

from caselake.jobs import main

main()
