from .job import main

main()
